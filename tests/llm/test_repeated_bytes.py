"""Removal of repeated bytes against all windows of all texts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import repeated_bytes as rb
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, width):
    seen = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        for p in range(len(b) - width + 1):
            seen[b[p:p + width]] = seen.get(b[p:p + width], 0) + 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] > 1:
                gone[p + 1:p + 1 + width] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        out.append((d, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_all_windows(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted(map(tuple, QUERIES["op1_repeated_bytes"](spark, SF).collect()), key=repr)
    assert got == plain(rows, 200)
    assert sum(r[2] for r in got) > 10_000


@pytest.mark.parametrize("seed", [0, 1])
def test_made_up_texts(spark, seed):
    """Passages of lengths around the limit, cut and joined at random, texts
    of few letters, and texts that repeat themselves."""
    rng = random.Random(seed)
    word = lambda n, letters="abcdefgh é": "".join(rng.choices(letters, k=n))
    passages = [word(n) for n in (30, 48, 100, 180, 199, 200, 201, 230, 400, 700)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice([word(rng.randint(0, 90)), (p := rng.choice(passages)), p[rng.randint(0, 60):], p[:rng.randint(1, len(p))]]) for _ in range(rng.randint(0, 7)))
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, "a" * 199), (203, "a" * 200), (204, "b" * 201), (205, "ab" * 300), (206, "c" * 5000), (207, word(450, "xy")), (208, word(450, "x y")), (None, passages[-1]), (None, passages[-1]), (3, rows[3][1]), (3, passages[7])]
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, low int").repartition(5)
    got = sorted(map(tuple, rb.remove_repeats(docs, Scratch(spark, "t1")).collect()), key=repr)
    assert got == plain(rows, 200)


def test_a_passage_in_very_many_texts(spark):
    rng = random.Random(5)
    line = "".join(rng.choices("abcdefghij ", k=320))
    short = "".join(rng.choices("abcdefghij ", k=150))
    rows = [(i, "".join(rng.choices("abcdefghij ", k=rng.randint(50, 300))) + (line if i % 3 else short) + "".join(rng.choices("abcdefghij ", k=120))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, rb.remove_repeats(docs, Scratch(spark, "t1")).collect()), key=repr)
    assert got == plain(rows, 200)


def test_texts_after_removal(spark):
    passage = "é" * 150
    docs = spark.createDataFrame([(1, "a" + passage + "b", "x", 152, None), (2, passage + "cc", None, 0, 1), (3, None, "x", None, 2)], "doc_id long, text string, source string, n_chars long, n int")
    got = sorted(map(tuple, rb.without_repeats(docs, Scratch(spark, "t1")).collect()))
    assert got == [(1, "ab", "x", 2, None), (2, "cc", None, 2, 1), (3, "", "x", 0, 2)]
    assert rb.without_repeats(docs.limit(0), Scratch(spark, "t1")).collect() == []


def test_merged_spans():
    rng = np.random.default_rng(0)
    for _ in range(50):
        low = rng.integers(0, 50, rng.integers(1, 12))
        high = low + rng.integers(1, 9, len(low))
        marks = np.zeros(70, bool)
        for a, b in zip(low, high, strict=True):
            marks[a:b] = True
        a, b = rb.merged(low, high)
        again = np.zeros(70, bool)
        for x, y in zip(a, b, strict=True):
            again[x:y] = True
        assert (marks == again).all() and (a[1:] > b[:-1]).all()


def test_long_texts_in_pieces(spark):
    """Cuts at any place of a text find what the whole text has."""
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefghij é", k=700))
    long = "".join(rng.choice([line, line[:260], "".join(rng.choices("abcdefgh ", k=rng.randint(40, 400)))]) for _ in range(60))
    rows = [(1, long), (2, "x" + line), (3, "y" * 3000), (4, "".join(rng.choices("abcdefgh", k=4000))), (5, "b" * 200), (6, None)]
    docs = rb.keyed(spark.createDataFrame(rows, "doc_id long, text string")).drop("text")
    for piece in (301, 1000):
        scratch = Scratch(spark, "t1")
        out = rb.remove(docs, rb.repeated_spans(docs, scratch, 200, piece=piece), ["doc_id"])
        assert sorted(map(tuple, out.collect()), key=repr) == plain(rows, 200)


def test_very_long_text(spark):
    """16 MiB without a repeat but for one passage at its two ends."""
    rng = np.random.default_rng(3)
    body = rng.integers(97, 123, 16 << 20, dtype=np.uint8).tobytes().decode()
    text = body[:500] + "." + body + "."
    docs = spark.createDataFrame([(1, text), (2, "z" * 150)], "doc_id long, text string")
    got = {r.doc_id: r for r in rb.remove_repeats(docs, Scratch(spark, "t1")).collect()}
    assert (got[1].n_bytes, got[1].n_removed, got[1].n_spans) == (len(text), 1000, 2)
    assert got[1].kept_sha256 == hashlib.sha256(("." + body[500:] + ".").encode()).hexdigest()
    assert (got[2].n_removed, got[2].n_spans) == (0, 0)


def test_very_many_equal_rows(spark):
    """Copies with one id, or without one, are settled as one row each."""
    rng = random.Random(9)
    text = "".join(rng.choices("abcdefghij ", k=2000))
    other = "".join(rng.choices("abcdefghij ", k=300)) + text[500:900] + "end"
    docs = (spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id").withColumn("text", F.lit(text))
            .union(spark.range(20_000).select(F.lit(7).cast("long"), F.lit(text)))
            .union(spark.range(5_000).select(F.lit(8).cast("long"), F.lit(text[:150])))
            .union(spark.createDataFrame([(9, other), (None, other[:250])], "doc_id long, text string")))
    got = rb.remove_repeats(docs, Scratch(spark, "t1")).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 2000, 2000, 1, 20_000), (7, 2000, 2000, 1, 20_000), (8, 150, 0, 0, 5_000), (9, 703, 650, 2, 1), (None, 250, 250, 1, 1)], key=repr)
