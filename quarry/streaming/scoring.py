"""Scoring a stream with fitted statistics.

The reference has no streaming. Fitted scalers and k-means centres are
plain projections, though, so the same operators label rows of a Structured
Streaming frame: rows arriving at ``readStream`` are scaled and assigned to
their nearest centre micro-batch by micro-batch, with no state kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.scalar import label_concat
from quarry.operators.cluster import assign_nearest
from quarry.operators.scale import ScalerStats, apply_scaler


def score_stream(stream: DataFrame, stats: ScalerStats, centers: list[list[float]],
                 prefix: str = "cluster_") -> DataFrame:
    """Scale the fitted columns and label each row with its nearest centre
    (``cluster`` INT, ``dist2``, ``cluster_label`` text). Works on batch and
    streaming frames alike."""
    scaled = apply_scaler(stream, stats, suffix="_scaled")
    feats = [c + "_scaled" for c in stats.cols]
    out = assign_nearest(scaled, feats, centers)
    return out.withColumn("cluster_label", label_concat(prefix, out["cluster"]))


def start_scoring(stream: DataFrame, stats: ScalerStats, centers: list[list[float]],
                  sink_path: str, checkpoint_location: str,
                  available_now: bool = False) -> StreamingQuery:
    """Write scored rows to parquet at ``sink_path`` (exactly-once through
    the file sink and the checkpoint, which must be on shared storage)."""
    writer = (score_stream(stream, stats, centers).writeStream.format("parquet")
              .option("path", sink_path).option("checkpointLocation", checkpoint_location)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
