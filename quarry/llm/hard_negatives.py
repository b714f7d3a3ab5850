"""Hard negatives by Strassen multiplication of anchor and candidate tiles.

Components become whole numbers, ``floor(scale * x)``, and a row's score with an
anchor is their inner product. Anchors are packed into blocks and all rows into
tiles of a bounded number of rows; a join lets every block meet every tile, and
each meeting is one product of int64 matrices by Strassen's recursion: odd sides
get a row or column of zeros, seven half-size products are combined by
additions, and small matrices are multiplied directly. Integer additions are
exact, so are the scores.

The work takes two rounds, since a window is known only once an anchor's
positives are. Round one keeps, per meeting, a heap of each anchor's best rows of
its own label; heaps of the same anchor are merged by rank. Round two multiplies
again and keeps, per positive, a heap of the best rows of other labels whose
score lies in the window ``low`` * p <= ``high`` * s <= ``high`` * p of the
positive's score p; these are merged in the same way. What leaves a meeting is
bounded by the heaps, whatever the tile holds, and equal scores are cut by id
inside the heap as they are after it.

The table meets a stated query set in blocks: the products grow with anchors x
rows, which the search needs, but each tile and block is packed once.

Rows with a null label, a null vector or a null or non-finite component take no
part; neither do rows whose integer vector is longer than 2^28 (their products
don't fit a long). Zero and empty vectors do. Shorter vectors are padded with
zeros. Ties go to the smaller id; a row without an id is never an anchor and comes
after all ids. Rows that share an id are separate rows, as anchors, positives
and negatives. An anchor without positives, and a positive without negatives,
gives no row. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions

TILE_VALUES, BLOCK_VALUES = 1 << 18, 1 << 14
LEAF = 16
LONGEST = float(1 << 28)
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out


def heaps(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` best allowed entries; of equal ones the
    earlier columns."""
    some = np.flatnonzero(allowed.any(axis=1))
    allowed, scores = allowed[some], scores[some]
    n = scores.shape[1]
    if n > k:
        least = np.partition(np.where(allowed, scores, _NONE), n - k, axis=1)[:, n - k]
        allowed = allowed & (scores >= least[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return some[row[keep]], column[keep]


def _pack(part: str, width: int) -> Callable:
    """One row per group: its rows in id order (null ids last) as matrices."""
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        number, ids = rows.column("row").to_numpy(), rows.column("vec_id")
        no_id = ids.is_null().to_numpy()
        ids = ids.fill_null(0).to_numpy()
        order = np.lexsort((number, ids, no_id))
        vectors = rows.column("v").combine_chunks()
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.zeros((len(number), width), np.int32)
        data[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
        out = {"number": number[order], "ids": ids[order], "no_id": no_id[order], "labels": rows.column("label").to_numpy()[order], "data": data[order]}
        if "bars" in rows.column_names:
            bars = rows.column("bars").to_pylist()
            most = max(map(len, bars), default=0)
            out["bars"] = np.array([bars[i] + [_NONE] * (most - len(bars[i])) for i in order], np.int64)
        yield pa.RecordBatch.from_pylist([{part: key[0].as_py(), **{c: a.tobytes() for c, a in out.items()}}])
    return run


class _Packed:
    """A packed row read back."""

    def __init__(self, batch: pa.RecordBatch, i: int, width: int, prefix: str = ""):
        def get(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(batch.column(prefix + name)[i].as_py(), kind)
        self.number, self.ids, self.no_id, self.labels = get("number", np.int64), get("ids", np.int64), get("no_id", bool), get("labels", np.int64)
        self.data = get("data", np.int32).reshape(len(self.ids), width).astype(np.int64)
        self.bars = get("bars", np.int64).reshape(len(self.ids), -1) if prefix + "bars" in batch.schema.names else None

    def named(self, at: np.ndarray) -> pa.Array:
        return pa.array(self.ids[at], pa.int64(), mask=self.no_id[at])


_PACKED = "number binary, ids binary, no_id binary, labels binary, data binary"


def mine(vectors: DataFrame, is_anchor: Column, scratch: Scratch, label: Column | str = "label", positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank), with integer ``label``."""
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    x = F.col(vector_col).cast("array<double>")
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = given.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("x", F.transform("x", lambda c: F.floor(c * scale).cast("double")))
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c)
    whole = whole.where(square <= F.lit(LONGEST * LONGEST)).select("vec_id", "label", F.col("x").cast("array<int>").alias("v"), (F.col("anchor") & F.col("vec_id").isNotNull()).alias("anchor"))
    rows = scratch.write(whole.withColumn("row", F.monotonically_increasing_id()), "rows")
    n, n_anchors, width = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(1, width)
    tiles, blocks = (max(1, -(-count // max(16, values // width))) for count, values in ((n, TILE_VALUES), (n_anchors, BLOCK_VALUES)))
    parts = max(shuffle_partitions(spark), 1)

    def packed(df: DataFrame, name: str, part: str, count: int, more: str = "") -> DataFrame:
        dealt = df.withColumn(part, F.pmod(F.xxhash64("row"), F.lit(count)))
        return scratch.write(dealt.groupBy(part).applyInArrow(_pack(part, width), f"{part} long, {_PACKED}{more}"), name)

    index = packed(rows.select("row", "vec_id", "label", "v"), "tiles", "tile", tiles)

    def meet(asked: DataFrame, run: Callable, schema: str) -> DataFrame:
        """Every block with every tile, in partitions by tile."""
        names = [c for c in asked.columns if c != "block"]
        sent = asked.select(*[F.col(c).alias("a_" + c) for c in names], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("tile"))
        return sent.repartition(parts, "tile").join(index.repartition(parts, "tile"), "tile").mapInArrow(run, schema)

    def best(found: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
        """Heaps of the same keys merged; tasks pass on k rows a key at most."""
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
        return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, c = _Packed(batch, i, width, "a_"), _Packed(batch, i, width)
                scores = strassen(a.data, c.data.T)
                allowed = (a.labels[:, None] == c.labels) & (a.number[:, None] != c.number)
                r, at = heaps(scores, allowed, positives)
                yield pa.RecordBatch.from_arrays([pa.array(a.number[r]), pa.array(a.ids[r]), pa.array(c.number[at]), c.named(at), pa.array(scores[r, at])], names=["anchor", "anchor_id", "row", "vec_id", "score"])

    def other_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, c = _Packed(batch, i, width, "a_"), _Packed(batch, i, width)
                scores = strassen(a.data, c.data.T)
                others = a.labels[:, None] != c.labels
                for p in range(a.bars.shape[1]):
                    bar = a.bars[:, p, None]
                    known = bar != _NONE
                    bar = np.where(known, bar, 0)
                    r, at = heaps(scores, others & known & (low * bar <= high * scores) & (scores <= bar), negatives)
                    yield pa.RecordBatch.from_arrays([pa.array(a.number[r]), pa.array(np.full(len(r), p + 1, np.int32)), pa.array(c.number[at]), c.named(at), pa.array(scores[r, at])], names=["anchor", "p", "row", "vec_id", "score"])

    anchors = rows.where("anchor").select("row", "vec_id", "label", "v")
    first = meet(packed(anchors, "anchors", "block", blocks), same_label, "anchor long, anchor_id long, row long, vec_id long, score long")
    chosen = scratch.write(best(first, ["anchor"], positives, "p").select("anchor", "anchor_id", "p", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    bars = chosen.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "positive_score"))), lambda s: s["positive_score"]).alias("bars"))
    asked = packed(anchors.join(bars.withColumnRenamed("anchor", "row"), "row"), "windows", "block", blocks, ", bars binary")
    second = meet(asked, other_labels, "anchor long, p int, row long, vec_id long, score long")
    windows = best(second, ["anchor", "p"], negatives, "rank")
    return (windows.select("anchor", "p", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(chosen, ["anchor", "p"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("p").alias("positive_rank")))
