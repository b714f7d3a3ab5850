"""Near-duplicate documents by SuperMinHash signatures, banding, verification
on full sets and union-find grouping.

1. Sketch. A document's set is its distinct ``words``-word shingles (64-bit
   hashes). SuperMinHash gives each element one random value and one place per
   step, the places of an element being a permutation drawn step by step; a
   signature cell keeps the smallest step + value of the elements that took
   its place. The values of step j lie in [j, j + 1), so once a document's
   largest cell is below j + 1 later steps cannot change it and it stops:
   long documents end after one step.
2. Classes. Documents with equal sets (a 128-bit sum over their elements, and
   their number) are one class, represented by its smallest id. Only
   representatives go on, so exact copies never meet as pairs.
3. Bands of ``rows`` cells. In every bucket (band, cells) each member is
   paired with the smallest one only; pairs are verified on full sets and the
   links are grouped.
4. Buckets that then still hold different components are looked at again, in
   tiles: a bucket is cut into parts of about ``part_rows`` members by a hash,
   and each two parts meet in a task with their texts. The task compares
   members of different components, unless both are in the bucket's smallest
   one, where set sizes allow the threshold, the share of equal signature cells
   is not ``SLACK`` standard errors below it, this is the first band that both
   share, and the links found so far in the task do not join them already. It
   passes on the links that join something, never a pair that fails, so a
   large group of look-alikes costs comparisons but no rows. The components of
   all links together are the result. Each two members of a bucket are then in
   one component, or were compared, or ruled out: the components lose nothing
   that the bands found.

With 28 bands of 4 cells a pair of similarity 0.8 shares no band with a
probability of 4e-7, 1 - (1 - s^4)^28; the cut of step 4 rules one out with
4e-6.

Confirmed links have 100 * intersection >= 80 * union (``threshold`` in
percent) on the full sets.

A null or empty text, or one without words, has an empty set and is linked
with nothing. Rows that share an id are one document linked to itself; each
gives a row. Rows without an id are compared under numbers of their texts from
2^62 on (ids have to be smaller), so they link like others; their ids are null in
the result, and so is the component of a group without any id, whose rows all
count as kept. An empty table gives an empty result. Other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.bytehash import U, column_bytes, mix, shingles
from quarry.llm.common import Scratch, arrow_slices, releasing, shuffle_partitions, texts, whole_rows
from quarry.llm.graph import Forest, components

BANDS, ROWS = 28, 4
WORDS, THRESHOLD = 5, 80
#: Rows without an id go by numbers from here on while they are compared.
NO_ID = 1 << 62
#: Standard errors of the cut, and members of a part, in step 4.
SLACK, PART_ROWS = 4.5, 512
SLICE = 2 << 20


def super_minhash(elements: np.ndarray, offsets: np.ndarray, cells: int) -> np.ndarray:
    """Signatures (sets x cells) of sets of 64-bit hashes: step in the upper
    half of a cell, value in the lower. Cells of an empty set are all ones."""
    sets = len(offsets) - 1
    owner = np.repeat(np.arange(sets), np.diff(offsets))
    best = np.full(sets * cells, ~U(0), U)
    alive = np.arange(len(elements))
    places = None
    for step in range(cells):
        drawn = mix(elements[alive] + U((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        other = step + ((drawn & U(0xFFFFFFFF)) * U(cells - step) >> U(32)).astype(np.int64)
        if step == 0:
            place, first = other, other
        else:
            if places is None:  # the draw of step 0 swapped two places
                kept = alive
                row_of = np.empty(len(elements), np.int64)
                row_of[kept] = np.arange(len(kept))
                places = np.tile(np.arange(cells, dtype=np.uint16 if cells > 256 else np.uint8), (len(kept), 1))
                places[np.arange(len(kept)), first[kept]] = 0
                places[:, 0] = first[kept]
            rows = row_of[alive]
            place = places[rows, other].astype(np.int64)
            places[rows, other] = places[rows, step]
            places[rows, step] = place
        np.minimum.at(best, owner[alive] * cells + place, (drawn >> U(32)) | U(step << 32))
        worst = best.reshape(sets, cells).max(axis=1) if sets else np.empty(0, U)
        alive = alive[worst[owner[alive]] >= U((step + 1) << 32)]
        if not len(alive):
            break
    return best.reshape(sets, cells)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=U) * U(0xA24BAED4963EE407), (len(signatures), bands)).copy()
    for r in range(rows):
        keys = mix(keys + signatures[:, r::rows][:, :bands])
    return keys


def sketches(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, cells) of each document; ``cells`` are
    the low bits of the signature's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "text", SLICE):
                elements, offsets = shingles(*column_bytes(part.column("text")), words)
                signatures = super_minhash(elements, offsets, bands * rows)
                keys = band_keys(signatures, bands, rows)
                low = (signatures & U(0xFFFF)).astype(np.uint16).view(np.int16).reshape(-1)
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(elements ^ U(salt)), dtype=U)])
                    sums.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1).view(np.int64)))
                cells = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * bands * rows), pa.array(low))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(sums[0]), pa.array(sums[1]), lists, cells],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands", "cells"])

    return docs.mapInArrow(releasing(run), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, cells array<short>")


def verify(pairs: DataFrame, held: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "text_b", SLICE):
                # a pair's first text is often that of the pair before
                coded = part.column("text_a").dictionary_encode()
                left, lo = shingles(*column_bytes(coded.dictionary), words)
                right, ro = shingles(*column_bytes(part.column("text_b")), words)
                keep = np.zeros(part.num_rows, bool)
                for i, c in enumerate(coded.indices.to_pylist()):
                    x, y = left[lo[c]:lo[c + 1]], right[ro[i]:ro[i + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i] = common > 0 and 100 * common >= threshold * (len(x) + len(y) - common)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    held = held.select(F.col("doc_id"), "text")
    joined = (pairs.join(held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
              .join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _tile_links(words: int, threshold: int, least_cells: int):
    """The links that join something in each tile of open buckets."""
    tile = ("bucket", "low", "high")

    def links_of(rows: pa.Table, cuts: list[int]) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        bucket, low, high, part, rep, c, main = (rows.column(x).to_numpy() for x in ("bucket", "low", "high", "part", "rep", "c", "main"))
        wide = lambda x: np.concatenate([k.flatten().to_numpy() for k in rows.column(x).chunks]).reshape(len(rep), -1)
        bands, cells = wide("bands"), wide("cells")
        elements, offsets = shingles(*column_bytes(rows.column("text").combine_chunks()), words)
        size = np.diff(offsets)
        found = []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            forest = Forest()
            inside = low[start] == high[start]
            for x in range(start, stop):
                if c[x] == main[x]:
                    continue
                y = np.arange(start, stop)
                y = y[(c[y] != c[x]) & ((c[y] == main[x]) | (y > x)) & (inside | (part[y] != part[x]))
                      & (100 * np.minimum(size[y], size[x]) >= threshold * np.maximum(size[y], size[x]))]
                y = y[(cells[y] == cells[x]).sum(axis=1) >= least_cells]
                same = bands[y] == bands[x]
                y = y[bands[x][same.argmax(axis=1)] == bucket[x]]
                for k in y.tolist():
                    # members of one component stand for each other
                    if forest.root(int(c[x])) == forest.root(int(c[k])):
                        continue
                    a, b = elements[offsets[x]:offsets[x + 1]], elements[offsets[k]:offsets[k + 1]]
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * common >= threshold * (len(a) + len(b) - common):
                        forest.join(int(c[x]), int(c[k]))
                        found.append((int(c[x]), int(c[k])))
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for piece in arrow_slices(batch, "text", SLICE):
                rows = pa.Table.from_batches([piece])
                rows = rows if held is None else pa.concat_tables([held, rows])
                key = np.column_stack([rows.column(t).to_numpy() for t in tile])
                cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
                last = int(cuts[-1]) if len(cuts) else 0
                if last:
                    yield links_of(rows.slice(0, last), [0, *cuts.tolist()])
                held = rows.slice(last)
        if held is not None and held.num_rows:
            yield links_of(held, [0, held.num_rows])

    return run


def near_duplicates(docs: DataFrame, scratch: Scratch, words: int = WORDS, threshold: int = THRESHOLD,
                    bands: int = BANDS, rows: int = ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``."""
    out = _groups(docs, scratch, words, threshold, bands, rows, part_rows)
    known = lambda c: F.when(F.col(c) < NO_ID, F.col(c)).alias(c)
    return out.select(known("doc_id"), "n_shingles", known("component_id"), ((F.col("doc_id") >= NO_ID) & (F.col("component_id") >= NO_ID) | F.col("kept")).alias("kept"))


def _numbered(doc_id: Column, text: Column) -> Column:
    """The id, or for rows without one a number of their text's beyond all ids."""
    return F.coalesce(doc_id, F.lit(NO_ID).bitwiseOR(F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1))))


def _groups(docs: DataFrame, scratch: Scratch, words: int, threshold: int, bands: int, rows: int, part_rows: int) -> DataFrame:
    given = texts(docs).withColumn("doc_id", _numbered(F.col("doc_id"), F.col("text")))
    sketch = scratch.write(sketches(given, words, bands, rows), "sketch")
    key = ["d1", "d2", "n_shingles"]
    classes = (sketch.where("n_shingles > 0").groupBy(*key)
               .agg(F.min("doc_id").alias("rep"), F.min("bands").alias("bands"), F.min("cells").alias("cells")))
    classes = scratch.write(classes, "classes")
    placed = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead <> last")
    # written first: a join of two plain tables is split at a very common bucket
    shared = scratch.write(shared.select("bucket", "lead"), "shared")
    members = scratch.write(placed.join(shared, "bucket"), "members")
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    held = scratch.write(given.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi").distinct(), "held")
    pairs = members.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    groups = components(scratch.write(verify(pairs, held, words, threshold), "links"), scratch, "groups")

    # buckets that hold several components, in tiles
    named = scratch.write(members.join(groups, members["rep"] == groups["node"], "left")
                          .select("bucket", "rep", F.coalesce("component", "rep").alias("c")), "named")
    mixed = (named.groupBy("bucket").agg(F.min("c").alias("main"), F.max("c").alias("other"), F.count(F.lit(1)).alias("n"))
             .where("main <> other").select("bucket", "main", F.ceil(F.col("n") / part_rows).cast("int").alias("parts")))
    seats = (named.join(scratch.write(mixed, "mixed"), "bucket").withColumn("part", F.pmod(F.hash("rep"), F.col("parts")))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("bucket", "rep", "c", "main", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")))
    sets = classes.select(F.col("rep").alias("doc_id"), "bands", "cells").join(held, "doc_id").withColumnRenamed("doc_id", "rep")
    tile = ["bucket", "low", "high"]
    spread = (seats.join(sets, "rep").repartition(shuffle_partitions(docs.sparkSession), *tile).sortWithinPartitions(*tile))
    share, count = threshold / 100, bands * rows
    least = int(max(0.0, share * count - SLACK * (share * (1 - share) * count) ** 0.5))
    late = spread.mapInArrow(releasing(_tile_links(words, threshold, least)), "a long, b long").distinct()
    stars = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(scratch.write(stars.union(late), "all-links"), scratch, "final")

    grouped = (classes.drop("bands", "cells").join(final, classes["rep"] == final["node"], "left")
               .select(*[F.col(k).alias(f"_{k}") for k in key], F.coalesce("component", "rep").alias("component")))
    grouped = scratch.write(grouped, "grouped")
    on = (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & (F.col("n_shingles") == F.col("_n_shingles"))
    found = F.coalesce("component", "doc_id")
    out = scratch.write(sketch.drop("bands", "cells").join(grouped, on, "left")
                        .select("doc_id", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept")), "result")
    scratch.drop("sketch", "classes", "shared", "members", "held", "links", "named", "mixed", "all-links", "grouped")
    return out


def first_of_each(docs: DataFrame, scratch: Scratch, words: int = WORDS, threshold: int = THRESHOLD,
                  bands: int = BANDS, rows: int = ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """``docs`` without the documents that are not the first of their group.
    Rows that share an id are one document, and so are rows without an id that
    share a text; rows without an id come after all others."""
    found = _groups(docs, scratch, words, threshold, bands, rows, part_rows)
    gone = found.where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    given = whole_rows(docs)
    number = _numbered(F.col("row.doc_id").cast("long"), F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    return given.join(gone.hint("shuffle_hash"), number == F.col("gone"), "left_anti").select("row.*")
