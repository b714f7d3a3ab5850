"""Nearest neighbours by largest inner product with vantage-point trees.

Inner products become distances by one more component: with M the largest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have |q' - x'|^2 = |q|^2 + M^2 -
2 q.x, so the nearest x' has the largest product. Rows are dealt to shards by
a hash, and each shard is one vantage-point tree: a node's vantage point splits
the rest by the median distance to it.

A block of queries walks a shard's tree together. First each query goes down
to the leaf on its side, which bounds its distance to the 20th neighbour from
above. Then the tree is passed once in order, each node with the queries that
still need it: by the triangle inequality a side holds nothing nearer than the
gap between the query's distance and the side's, and is skipped where
``factor`` x gap exceeds the bound. Factor 1 is exact; larger ones skip more.
M is the largest norm of the shard. Where a shard's norms differ by more than
``ALIKE``, the added component keeps queries far from all rows, gaps are large
whatever the product, and a relaxed gap would skip the best rows: such a shard
is searched with factor 1. All components are scaled by the largest one before
they are squared, which changes no order. A leaf is one matrix product.

Every shard meets every block in a join of the two numbered tables, and a
query's results of all shards are ranked. Scores are products of the original
vectors in double precision, summed in one fixed order; ties go to the smaller
id. A shard and a block have bounded mean sizes, whatever the table's.

Vectors that are null, zero, hold a null or a non-finite component, or have
another length than most, take no part; neither do rows without an id. Rows
that share an id are one vector (the smallest). An empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions
from quarry.llm.vectors import common_length, matrix, usable

SHARD_ROWS, BLOCK_ROWS, LEAF = 8192, 1024, 256
FACTOR = 1.25
ALIKE = 0.9


@dataclass
class Tree:
    """Nodes in preorder. A node covers the rows low .. high - 1 of ``order``;
    an inner node's first row is its vantage point, ``inside`` rows after it are
    within ``near``, the others at ``far`` or beyond."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    inside: np.ndarray
    near: np.ndarray
    far: np.ndarray
    left: np.ndarray
    right: np.ndarray


def build(points: np.ndarray, leaf: int = LEAF, seed: int = 0) -> Tree:
    rng, order, nodes = np.random.default_rng(seed), np.arange(len(points)), []

    def grow(low: int, high: int) -> int:
        at = len(nodes)
        nodes.append([low, high, 0, 0.0, 0.0, -1, -1])
        if high - low <= leaf:
            return at
        chosen = low + rng.integers(high - low)
        order[[low, chosen]] = order[[chosen, low]]
        rest = order[low + 1:high]
        away = np.sqrt(((points[rest] - points[order[low]]) ** 2).sum(axis=1))
        half = len(rest) // 2
        by = np.argpartition(away, half)
        order[low + 1:high] = rest[by]
        away = away[by]
        nodes[at][2:5] = [half, away[:half].max(), away[half:].min()]
        nodes[at][5] = grow(low + 1, low + 1 + half)
        nodes[at][6] = grow(low + 1 + half, high)
        return at

    if len(points):
        grow(0, len(points))
    columns = list(zip(*nodes, strict=True)) if nodes else [()] * 7
    return Tree(order, *(np.array(columns[i], np.float64 if i in (3, 4) else np.int64) for i in range(7)))


class Search:
    """The ``k`` best rows of one shard for each query of a block."""

    def __init__(self, tree: Tree, points: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, factor: float):
        self.tree, self.factor, self.k = tree, factor, k
        self.points, self.ids = points[tree.order], ids[tree.order]
        self.queries, self.query_ids = queries, query_ids
        n = len(queries)
        self.best = np.full((n, k), np.inf)  # distances, unordered
        self.bound = np.full(n, np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []
        self.squares, self.query_squares = (self.points ** 2).sum(axis=1), (queries ** 2).sum(axis=1)
        self.evaluated = 0

    def _scan(self, who: np.ndarray, low: int, high: int) -> None:
        """Compare queries with the rows low .. high - 1."""
        self.evaluated += len(who) * (high - low)
        square = self.query_squares[who, None] + self.squares[low:high] - 2 * (self.queries[who] @ self.points[low:high].T)
        away = np.sqrt(np.maximum(square, 0))
        away[self.query_ids[who, None] == self.ids[low:high]] = np.inf
        hit = away <= self.bound[who, None] * (1 + 1e-9) + 1e-9
        hit &= away < np.inf
        q, x = np.nonzero(hit)
        self.found.append((who[q], x + low))
        near = np.partition(np.concatenate([self.best[who], away], axis=1), self.k - 1, axis=1)[:, :self.k]
        self.best[who], self.bound[who] = near, near.max(axis=1)

    def _gap(self, who: np.ndarray, node: int) -> np.ndarray:
        p = self.points[self.tree.low[node]]
        return np.sqrt(((self.queries[who] - p) ** 2).sum(axis=1))

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs that may be among the best, each once."""
        tree, home = self.tree, {}
        if not len(tree.low) or not len(self.queries):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        stack = [(0, np.arange(len(self.queries)))]
        while stack:  # down to the leaf on each query's side
            node, who = stack.pop()
            if not len(who):
                continue
            if tree.left[node] < 0:
                home[node] = who
                self._scan(who, tree.low[node], tree.high[node])
                continue
            inside = self._gap(who, node) <= (tree.near[node] + tree.far[node]) / 2
            stack += [(tree.right[node], who[~inside]), (tree.left[node], who[inside])]
        stack = [(0, np.arange(len(self.queries)), None)]
        while stack:
            node, who, gap = stack.pop()
            if gap is not None:
                who = who[self.factor * gap <= self.bound[who]]
            if not len(who):
                continue
            if tree.left[node] < 0:
                if node in home:
                    who = np.setdiff1d(who, home[node], assume_unique=True)
                if len(who):
                    self._scan(who, tree.low[node], tree.high[node])
                continue
            self._scan(who, tree.low[node], tree.low[node] + 1)
            away = self._gap(who, node)
            stack += [(tree.right[node], who, tree.far[node] - away), (tree.left[node], who, away - tree.near[node])]
        q, x = (np.concatenate(c) for c in zip(*self.found, strict=True))
        return q, x


def top(scores: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each query, ties to smaller ids."""
    order = np.lexsort((ids, -scores, query))
    sorted_query = query[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_query, sorted_query)
    return order[rank < k]


def nearest(vectors: DataFrame, is_query: Column, scratch: Scratch, k: int = 20, factor: float = FACTOR,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    width = common_length(given, "v")
    rows = given.where(F.col("vec_id").isNotNull() & usable("v") & (F.size("v") == width)).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    rows = scratch.write(rows, "vectors")
    most = F.array_max(F.transform("v", F.abs))
    n, n_queries, unit = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.coalesce(F.max(most), F.lit(1.0))).first()
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_ROWS))

    def pack(kind: str):
        def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches)).combine_chunks()
            ids = table.column("vec_id").to_numpy()
            v = np.concatenate([matrix(c, width) for c in table.column("v").chunks]) if len(ids) else np.empty((0, width))
            order = np.argsort(ids, kind="stable")
            ids, v = ids[order], v[order]
            out = {"ids": ids.tobytes(), "data": v.tobytes()}
            if kind == "shard":
                tree = build(lifted(v / unit)[0], seed=int(key[0].as_py()))
                out["tree"] = np.concatenate([[len(tree.low)], tree.order, *(getattr(tree, c).view(np.int64) for c in _NODE)]).astype(np.int64).tobytes()
            yield pa.RecordBatch.from_pylist([{kind: key[0].as_py(), **out}])
        return run

    of = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts))
    index = scratch.write(rows.select(of(shards).alias("shard"), "vec_id", "v").groupBy("shard").applyInArrow(pack("shard"), "shard long, ids binary, data binary, tree binary"), "index")
    asked = scratch.write(rows.where("q").select(of(blocks).alias("block"), "vec_id", "v").groupBy("block").applyInArrow(pack("block"), "block long, ids binary, data binary"), "queries")
    meet = (asked.select("block", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
            .repartition(max(shuffle_partitions(spark), 1), "shard", "block")
            .join(index, "shard"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c: np.frombuffer(batch.column(c)[i].as_py(), np.int64 if c in ("ids", "q_ids", "tree") else np.float64)  # noqa: B023, E731
                ids, v, q_ids, q = get("ids"), get("data").reshape(-1, width), get("q_ids"), get("q_data").reshape(-1, width)
                tree = unpack_tree(get("tree"), len(ids))
                points, alike = lifted(v / unit)
                found = Search(tree, points, ids, np.column_stack([q / unit, np.zeros(len(q))]), q_ids, k, factor if alike else 1.0)
                who, at = found.run()
                at = tree.order[at]
                scores = np.empty(len(who))
                for low in range(0, len(who), 1 << 16):
                    part = slice(low, low + (1 << 16))
                    scores[part] = np.einsum("ij,ij->i", q[who[part]], v[at[part]])
                best = top(scores, who, ids[at], k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[who[best]]), pa.array(ids[at[best]]), pa.array(scores[best])], names=["query_id", "vec_id", "score"])

    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (meet.select("ids", "data", "tree", "q_ids", "q_data").mapInArrow(search, "query_id long, vec_id long, score double")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


_NODE = ("low", "high", "inside", "near", "far", "left", "right")


def lifted(v: np.ndarray) -> tuple[np.ndarray, bool]:
    """Rows with the component that makes all norms equal, and whether they were
    alike before."""
    square = (v ** 2).sum(axis=1)
    largest = square.max(initial=0.0)
    return np.column_stack([v, np.sqrt(np.maximum(largest - square, 0))]), bool(square.min(initial=largest) >= ALIKE ** 2 * largest)


def unpack_tree(packed: np.ndarray, rows: int) -> Tree:
    n = int(packed[0])
    parts = [packed[1 + rows + i * n:1 + rows + (i + 1) * n] for i in range(7)]
    return Tree(packed[1:1 + rows], *(p.view(np.float64) if c in ("near", "far") else p for c, p in zip(_NODE, parts, strict=True)))
