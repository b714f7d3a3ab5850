"""Sources and sinks: parquet tables, SQL over views, JDBC, CSV, snapshots, blobs."""
