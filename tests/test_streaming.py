"""Fitted scaler + centres applied to a Structured Streaming source."""

import os
import tempfile

from pyspark.sql import functions as F

from quarry.operators.cluster import assign_nearest, fit_kmeans, centers_of
from quarry.operators.scale import apply_scaler, fit_scaler
from quarry.streaming.scoring import score_stream, start_scoring

from conftest import SF001


def test_stream_scoring_matches_batch(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    feats = ["l_quantity", "l_discount"]
    stats = fit_scaler(li, feats, "minmax")
    model = fit_kmeans(apply_scaler(li, stats), feats, 3, seed=713)
    centers = centers_of(model)
    scratch = tempfile.mkdtemp(prefix="quarry-stream-")
    src = os.path.join(scratch, "in")
    li.select("l_orderkey", "l_linenumber", *feats).repartition(3).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = start_scoring(stream, stats, centers, os.path.join(scratch, "out"),
                      os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(scratch, "out"))
    batch = score_stream(spark.read.parquet(src), stats, centers)
    a = sorted((r["l_orderkey"], r["l_linenumber"], r["cluster"]) for r in got.collect())
    b = sorted((r["l_orderkey"], r["l_linenumber"], r["cluster"]) for r in batch.collect())
    assert a == b and len(a) == li.count()
    assert got.filter(~F.col("cluster_label").startswith("cluster_")).count() == 0
    assert assign_nearest is not None
