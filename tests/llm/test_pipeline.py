"""Each stage of the pipeline against a plain version of it."""

import hashlib
import math
import re

from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm.encode import Encoder, vocabulary
from quarry.llm.queries import QUERIES
from test_mixing import plain_targets
from test_near_dedup import plain as plain_groups
from test_repeated_bytes import plain as plain_removal
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def plain_mix(rows):
    """Texts of the mix: documents in hash order, repeated up to the target."""
    sizes, by_source = {}, {}
    for r in rows:
        n = len(re.findall(WORD, r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        by_source.setdefault(r.source, []).append((hashlib.md5(f"{r.doc_id}:0".encode()).hexdigest(), r.doc_id, n, r.text))
    target, out = plain_targets(sizes), []
    for source, docs in by_source.items():
        left = math.floor(target[source] + 1e-9)
        while left > 0:
            for _, doc_id, n, text in sorted(docs):
                take = min(n, left)
                if take:
                    out.append((doc_id, text if take == n else " ".join(re.findall(WORD, text)[:take])))
                left -= take
    return sorted(out)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", None, 0), (9002, "123 ...", None, "src1", 7), (9003, "", "en", "src1", 0), (9004, "Only this one, and nothing else here.", None, None, 37)], docs.schema)
    docs = docs.union(extra)
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "repeated_bytes", "mixing", "packing"]
    given = docs.collect()

    rows = stages["language_id"](spark, docs, SF).collect()
    lettered = [r for r in given if any(c.isalpha() for c in r.text or "")]
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(by_id) == len(lettered) and all(by_id[r.doc_id] == r for r in lettered if r.lang is not None)
    found = {r.doc_id: r.lang_pred for r in QUERIES["op3_language_id"](spark, SF).collect()}
    filled = [r for r in lettered if r.lang is None]  # a missing language is the predicted one
    assert filled and all(by_id[r.doc_id].lang is not None and by_id[r.doc_id].lang == found.get(r.doc_id, by_id[r.doc_id].lang) for r in filled)

    docs = spark.createDataFrame(rows, docs.schema)
    out = stages["near_dedup"](spark, docs, SF)
    kept = {d for d, (_n, _c, keep) in plain_groups([(r.doc_id, r.text) for r in rows], words=5).items() if keep}
    assert out.columns == columns and 0 < len(kept) < len(rows)
    rows, before = out.collect(), rows
    assert sorted(map(str, rows)) == sorted(str(r) for r in before if r.doc_id in kept)

    docs = spark.createDataFrame(rows, docs.schema)
    out = stages["repeated_bytes"](spark, docs, SF)
    want = {r[0]: r[4] for r in plain_removal([(r.doc_id, r.text) for r in rows], 200)}
    assert out.columns == columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(want)
    whole = [r for r in rows if hashlib.sha256((r.text or "").encode()).hexdigest() == want[r.doc_id]]
    assert len(whole) >= 0.95 * len(rows)  # the others lost halves of characters
    assert all(r.n_chars == len(r.text) for r in rows)

    docs = spark.createDataFrame(rows, docs.schema)
    out = stages["mixing"](spark, docs, SF)
    assert out.columns == columns
    mixed = out.collect()
    assert sorted((r.doc_id, r.text) for r in mixed) == plain_mix(rows)

    docs = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(mixed)], docs.schema)
    check_packing(stages["packing"](spark, docs, SF).collect(), docs.collect(), Encoder(vocabulary("byte_bpe_50k.json")), 1, 2048)


def test_run_and_empty_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert rows and sum(r.length for r in rows) > 10_000
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_near_dedup_stage_compares_five_words(spark):
    """Five separate words of 200 differ: 0.816 on four-word shingles, 0.774 on five-word ones."""
    base = [f"w{i}" for i in range(200)]
    far = [f"x{i}" if i in (20, 60, 100, 140, 180) else w for i, w in enumerate(base)]
    near = [f"y{i}" if i in (30, 130) else w for i, w in enumerate(base)]
    rows = [(i, " ".join(t), "en", "src0", len(" ".join(t))) for i, t in enumerate((base, far, near))]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    docs = docs.union(spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10))
    given = [(r.doc_id, r.text) for r in docs.collect()]
    kept = sorted(d for d, (_n, _c, keep) in plain_groups(given, words=5).items() if keep)
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    got = sorted(r.doc_id for r in out.collect())
    assert got == kept and got[:2] == [0, 1] and 2 not in got


def test_stages_take_any_further_columns(spark):
    """Names that stages use themselves come out as they went in."""
    names = ["_text", "_lettered", "_gone", "gone", "_kept", "_words", "words", "_key", "_th", "_row", "row", "number", "size", "key", "score", "group", "ids", "n"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in names], F.struct(F.lit(1).alias("a b")).alias("odd.name"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in names), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
