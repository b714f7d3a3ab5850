"""Mixing against plain Python and DuckDB."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing, oracles
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left = share * sum(sizes.values()) - sum(target.values())
        over = [n for n in free if left * w[n] / sum(w[m] for m in free) >= cap * sizes[n]]
        if not over:
            return target | {n: left * w[n] / sum(w[m] for m in free) for n in free}
        target |= {n: cap * sizes[n] for n in over}
        free -= set(over)


def check(docs, out, shares=True):
    words = lambda t: len("".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t or "").split(" ")) - "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t or "").split(" ").count("")
    sizes, by_source, taken = {}, {}, {}
    for d in docs:
        sizes.setdefault(d.source, 0)
        sizes[d.source] += words(d.text)
        by_source[d.doc_id] = (d.source, words(d.text))
    want = plain_targets(sizes)
    for r in out:
        source, size = by_source[r.doc_id]
        assert r.size == size and r.source_size == sizes[source] and 0 <= r.taken <= 2 * size
        assert r.target == pytest.approx(want[source])
        taken[source] = taken.get(source, 0) + r.taken
    for source, n in taken.items():
        assert want[source] - 1.001 <= n <= want[source] + 0.001


def test_query_against_sql(spark):
    got = QUERIES["op8_mixing"](spark, SF)
    rows = sorted(tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in got.collect())
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert rows == sorted(duckdb.sql(f"SELECT doc_id, size, source_size, target, taken FROM ({oracles.OP8})").fetchall())
    check(table(spark, SF, "documents").collect(), got.collect())


def test_skewed_and_odd_rows(spark):
    rng = random.Random(3)
    names = ["a", "B", "é", None, "", "a b", "zz", "tiny", "empty"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 300)), rng.choice(names[:3] + ["a"] * 5 + names[3:7]), "s", 1) for i in range(400)]
    rows += [(1000, "one", "tiny", "s", 1), (1001, None, "empty", "s", 1), (1002, "x\x0b\x0cy z " + "long " * 5000, "a", None, None), (1003, "", None, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, s string, size int")
    mixed = mixing.mix(docs, Scratch(spark, "t8"), block=16)
    out = mixing.taken(mixed).collect()
    assert len(out) == len(rows)
    check(docs.collect(), out)
    slots = mixed.pieces.groupBy("slot").agg(F.countDistinct("s").alias("s"), F.sum("words").alias("n")).collect()
    assert all(r.s == 1 and r.n <= 16 for r in slots)
    again = mixing.taken(mixing.mix(docs.repartition(7), Scratch(spark, "t8"), block=16)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_schedule_is_even(spark):
    """Every prefix of the slots holds each source in proportion."""
    want = {0: 700, 1: 50, 2: 250, 3: 0, 4: 3}
    sources = spark.createDataFrame([(s, 10 * n - (n > 0)) for s, n in want.items()], "s int, words long")
    rows = sorted((r.slot, r.s, r["rank"]) for r in mixing.schedule(sources, 10).collect())
    assert len(rows) == len({r[0] for r in rows}) == sum(want.values())
    seen = dict.fromkeys(want, 0)
    for i, (_, s, rank) in enumerate(rows):
        assert rank == seen[s]
        seen[s] += 1
        if i < 900:
            assert all(abs(seen[t] - (i + 1) * n / sum(want.values())) <= 12 for t, n in want.items())
    assert seen == want


def test_rows_of_the_mix(spark):
    docs = spark.createDataFrame([(i, f"t{i} " * (i % 7), "ab"[i % 3 == 0], 0) for i in range(60)], "doc_id long, text string, source string, n_chars long")
    docs = docs.union(spark.createDataFrame([(None, "no id", "a", 0), (5, "same id", None, 0)], docs.schema))
    mixed = mixing.mix(docs.where("doc_id is not null and text <> 'same id'"), Scratch(spark, "t8"), block=8)
    out = mixing.mixed_documents(docs.where("doc_id is not null and text <> 'same id'"), Scratch(spark, "t8"), block=8)
    assert out.columns == docs.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(mixing.word_count("text")).alias("n")).collect()}
    assert got == {r.doc_id: r.taken for r in mixing.taken(mixed).collect() if r.taken}
    assert all(r.n_chars == len(r.text) for r in out.collect())
    every = mixing.mixed_documents(docs, Scratch(spark, "t8"), block=8, share=2.0)
    assert sorted(r.text for r in every.where("doc_id is null or text = 'same id'").collect()) == ["no id"] * 2 + ["same id"] * 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken(mixing.mix(docs, Scratch(spark, "t8"))).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, "", "a"), (2, "", "a"), (None, None, "a")], docs.schema)
    assert [r.taken for r in mixing.taken(mixing.mix(blank, Scratch(spark, "t8"))).collect()] == [0] * 4


def test_documents_come_in_the_schedules_order(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(10)), "ab"[i % 2]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [r.source for r in mixing.mixed_documents(docs, Scratch(spark, "t8"), weights=(1, 1), share=1.0, block=10).collect()]
    assert len(out) == 200
    for n in range(2, 201, 2):  # each prefix of the rows holds both sources alike
        assert abs(out[:n].count("a") - n / 2) <= 8
    one = [r.doc_id for r in mixing.mixed_documents(docs, Scratch(spark, "t8"), weights=(1, 1), share=1.0, block=10).collect()]
    other = [r.doc_id for r in mixing.mixed_documents(docs, Scratch(spark, "t8"), weights=(1, 1), share=1.0, block=500).collect()]
    assert sorted(one) == sorted(other) and one != other  # another schedule, another order
    slots = {r.doc_id: r.slot for r in mixing.taken(mixing.mix(docs, Scratch(spark, "t8"), weights=(1, 1), share=1.0, block=10)).collect()}
    assert [slots[d] for d in one] == sorted(slots.values())
