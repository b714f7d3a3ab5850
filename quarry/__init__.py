"""quarry: Spark-native data preparation, profiling and clustering.

Subpackages
-----------
functions  column expressions (missing values, recodes, labels, dates)
sources    parquet tables, SQL over views, JDBC, CSV, snapshots, blobs
operators  DataFrame -> DataFrame operators (columns, joins, profile,
           quantiles, clean, split, scale, cluster, plotdata, stats)
plans      workflows (acquire, prepare), materialisation, registered queries
streaming  fitted scalers and centres applied to Structured Streaming

Every operator builds a lazy Spark plan; data-dependent steps run one small
statistics job whose O(columns) / O(k) result shapes the next plan.
"""

__version__ = "0.1.0"
