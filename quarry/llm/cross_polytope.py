"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets.

A hash turns a vector by three rounds of random signs and a fast Hadamard
transform and takes the axis that it then lies nearest to, with its sign: one
of 2d values. A table joins ``hashes`` of them to a bucket. A vector is a
member of its own bucket and a guest of the ``hashes`` buckets that follow from
taking the second nearest axis in one hash. Members of a bucket are compared
with each other and with its guests: links are pairs whose cosine, in double
precision, reaches the threshold.

Equal vectors are one class; its smallest id stands for it, with its number.
A pair can meet in several tables. It is counted only where it meets first:
every row carries its buckets in all tables, so a task sees that on its own and
no pair leaves it. Tasks pass on partial link counts and, from a union-find
over their links, one link per vector. Buckets are cut into parts of about
``part_rows`` rows by a hash, and each two parts meet in a tile, so the rows of
a very common vector are spread over tasks.

With 2 hashes and 8 tables a pair of cosine 0.95 in 64 dimensions is missed
with a probability of about 1e-4, pairs of larger cosine less often. For many
more vectors than 10^8, 3 hashes and about 20 tables keep buckets small.

Vectors that are null, zero, hold a null or a non-finite component link with
nothing, nor do vectors of different length; each is returned with no links as
its own component. Rows that share an id are one vector each by the rules
above, with one component; their ``n_links`` count the other rows. A null id is
returned as null with 0 links. An empty table gives an empty result. Other
columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions
from quarry.llm.graph import Forest, components
from quarry.llm.vectors import unit, usable

TABLES, HASHES, THRESHOLD, PART_ROWS = 8, 2, 0.95, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x


def buckets(v: np.ndarray, tables: int = TABLES, hashes: int = HASHES, seed: int = 7) -> np.ndarray:
    """(rows, tables, 1 + hashes) bucket numbers: the own one, then those with
    the second nearest axis in one hash."""
    rows, d = v.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((rows, size))
    padded[:, :d] = v
    signs = np.random.default_rng([seed, d]).choice([-1.0, 1.0], size=(tables, hashes, 3, size))
    out = np.zeros((rows, tables, 1 + hashes), np.int64)
    at = np.arange(rows)
    for t in range(tables):
        choice = []
        for h in range(hashes):
            y = padded
            for turn in range(3):
                y = hadamard(y * signs[t, h, turn])
            far = np.abs(y)
            first = far.argmax(axis=1)
            far[at, first] = -1
            second = far.argmax(axis=1)
            choice.append([2 * a + (y[at, a] > 0) for a in (first, second)])
        for probe in range(1 + hashes):
            code = np.zeros(rows, np.int64)
            for h in range(hashes):
                code = code * (2 * size) + choice[h][probe == h + 1]
            out[:, t, probe] = code
    return out


def first_meeting(own: np.ndarray, guest: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of rows (a the smaller id) the first of the ways to meet, in
    the order table by table: equal buckets, a as b's bucket's guest, b as a's."""
    same = own[a] == own[b]
    a_visits = (guest[a] == own[b][:, :, None]).any(axis=2)
    b_visits = (guest[b] == own[a][:, :, None]).any(axis=2)
    ways = np.stack([same, a_visits, b_visits], axis=2).reshape(len(a), -1)
    return ways.argmax(axis=1)


def tile_links(ids: np.ndarray, v: np.ndarray, codes: np.ndarray, probe: np.ndarray, part: np.ndarray, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (positions, smaller id first) that meet first in this
    bucket; ``v`` has unit rows and ``part`` is -1 where all are compared."""
    close = v @ v.T >= threshold - 1e-9
    close &= ids[:, None] < ids
    close &= (probe[:, None] == 0) | (probe == 0)
    close &= (part[:, None] != part) | (part < 0)
    a, b = np.nonzero(close)
    if len(a):
        keep = np.einsum("ij,ij->i", v[a], v[b]) >= threshold
        a, b = a[keep], b[keep]
    if len(a):
        way = 3 * table + np.where(probe[a] > 0, 1, np.where(probe[b] > 0, 2, 0))
        keep = first_meeting(codes[:, :, 0], codes[:, :, 1:], a, b) == way
        a, b = a[keep], b[keep]
    return a, b


def near_duplicates(vectors: DataFrame, scratch: Scratch, threshold: float = THRESHOLD, tables: int = TABLES, hashes: int = HASHES,
                    part_rows: int = PART_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fit = usable("v") & F.col("vec_id").isNotNull()
    classes = scratch.write(given.where(fit).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("v"), batch.num_rows
            sizes = np.diff(lists.offsets.to_numpy())
            codes = np.zeros((n, tables, 1 + hashes), np.int64)
            flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
            for d in np.unique(sizes):
                of = np.flatnonzero(sizes == d)
                codes[of] = buckets(unit(flat[start[of][:, None] + np.arange(d)]), tables, hashes)
            wide = tables * (1 + hashes)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("copies"), pa.array(sizes.astype(np.int32)), lists,
                                              pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * wide), pa.array(codes.reshape(-1)))],
                                             names=["rep", "copies", "d", "v", "codes"])

    hashed = scratch.write(classes.mapInArrow(hash_rows, "rep long, copies long, d int, v array<double>, codes array<long>"), "hashed")
    seats = hashed.select("rep", "d", F.posexplode("codes").alias("seat", "code")).select(
        "rep", "d", "code", F.floor(F.col("seat") / (1 + hashes)).cast("int").alias("t"), (F.col("seat") % (1 + hashes)).alias("probe"))
    bucket = ["d", "t", "code"]
    full = (seats.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("probe") == 0).alias("own"))
            .where("own > 0 and n > 1").select(*bucket, F.ceil(F.col("n") / part_rows).cast("int").alias("parts")))
    seated = (seats.join(full, bucket).withColumn("part", F.pmod(F.hash("rep", "probe"), F.col("parts")))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("rep", *bucket, "probe", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")))
    tiles = seated.join(hashed.drop("d"), "rep")
    tile = ["d", "t", "code", "low", "high"]
    spread = tiles.repartition(shuffle_partitions(spark), *tile).sortWithinPartitions(*tile)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table_ = pa.Table.from_batches([batch])
            if held is not None:
                table_ = pa.concat_tables([held, table_])
            key = np.column_stack([table_.column(c).to_numpy() for c in tile])
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            last = int(cut[-1]) if len(cut) else 0
            if last:
                yield links_of(table_.slice(0, last), np.append(0, cut))
            held = table_.slice(last)
        if held is not None and held.num_rows:
            yield links_of(held, np.array([0, held.num_rows]))

    def links_of(rows: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        get = lambda c: rows.column(c).to_numpy()
        ids, copies, probe, part, low, high, t, d = map(get, ("rep", "copies", "probe", "part", "low", "high", "t", "d"))
        part = np.where(low == high, -1, part)
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("v").chunks])
        at = np.cumsum(d) - d
        codes = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("codes").chunks]).reshape(len(ids), tables, 1 + hashes)
        counts: dict[int, int] = {}
        forest = Forest()
        for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if stop - start < 2:
                continue
            v = flat[at[start]:at[start] + d[start] * (stop - start)].reshape(stop - start, d[start])
            v = unit(v)
            a, b = tile_links(ids[start:stop], v, codes[start:stop], probe[start:stop], part[start:stop], int(t[start]), threshold)
            if not len(a):
                continue
            for one, other in ((a, b), (b, a)):
                sums = np.bincount(one, weights=copies[start + other], minlength=stop - start)
                for i in np.flatnonzero(sums):
                    x = int(ids[start + i])
                    counts[x] = counts.get(x, 0) + int(sums[i])
            for x, y in zip(ids[start + a].tolist(), ids[start + b].tolist(), strict=True):
                forest.join(x, y)
        linked = [(x, n, forest.root(x)) for x, n in counts.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in linked], pa.int64()) for i in range(3)], names=["rep", "n", "root"])

    found = scratch.write(spread.mapInArrow(compare, "rep long, n long, root long"), "found")
    grouped = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    done = scratch.write(classes.join(counts, "rep", "left").join(grouped.select(F.col("node").alias("rep"), "component"), "rep", "left")
                         .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "done")
    out = (given.select("vec_id", F.when(fit, F.col("v")).alias("v"))
           .join(done.withColumnRenamed("v", "_v"), F.col("v") == F.col("_v"), "left"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
