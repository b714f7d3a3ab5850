"""Connected components by union-find within tasks and star contraction.

Each task joins the links that it holds in a union-find forest and passes on
one link per node, to its root. Links of different tasks then meet in rounds of
large and small stars: a node's larger neighbours, then its smaller ones, are
linked to the smallest of them. Both keep the components and end in one star
per component around its smallest node. A round is two aggregations with
partial sums and two joins; a node with very many links is a key of a join
whose large side can be split, never a gathered group. Every round is written
to the shared folder, so lineage stays short and lost executors cost one
round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch


class Forest:
    """Union-find over sparse ids; the root of a tree is its smallest id."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            forest.join(a, b)
    pairs = [(x, r) for x in forest.parent if (r := forest.root(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: each node has one smaller neighbour and no
    larger ones, or larger ones only."""
    ends = (links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .union(links.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.coalesce(F.sum((F.col("down") + F.col("up") > 1).cast("long")), F.lit(0))).first()[0] == 0


def components(links: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(a, b) -> (node, component) of every node with a link to another one;
    ``component`` is the smallest node reachable. Null ends and links of a
    node to itself are no links."""
    start = (links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where("a <> b"))
    now = scratch.write(start.mapInArrow(_contract, "u long, v long").distinct(), f"{name}-0")
    step = 0
    while not _settled(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        step += 1
        now = scratch.write(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
