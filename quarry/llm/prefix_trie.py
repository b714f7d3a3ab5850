"""The prefix trie of conversations by whole-sequence collapse.

A node is a distinct sequence of first turns. Conversations that are equal as a
whole are grouped first: what goes on are weighted sequences, each with its
number of conversations, its smallest one and a list of those that end there.
Sequences that are proper prefixes of others are dropped by an anti-join; the
rest are the leaves. The prefixes of the weighted sequences are then aggregated
into nodes.

A prefix is named by 128 bits: the exclusive or of hashes of (position, digest
of the turn), so that all prefixes of a sequence are running values and a
sequence may be as long as it likes: the running values go in chunks of ``CHUNK``
turns that are joined to the sums of the chunks before. Positions in a
conversation are found in the same way, by ranges of (conversation, turn) and
the counts of the ranges before, so a conversation with a third of all rows is
spread over many tasks. The lists of conversations at an end are joined in
chunks of a range partitioning, and one pass over these chunks in order feeds
the hash of the list; no list is held whole.

What a node's subtree holds is a sum over the sequences through it, not over its
nodes. A sequence owns the nodes whose smallest member it is; they are the last
ones of its path, so one number per sequence tells them. With T(d) the code
points of a sequence's first d turns, w its weight and o the depth of its last
node that it does not own, it adds w * (T(end) - T(d - 1)) for the members and
takes T(end) - T(max(o, d - 1)) for the nodes themselves.

A null role or text is empty. Turns go by number, null first, then by digest of
role and text; rows that repeat are turns of their own. Rows without a
conversation id belong to no conversation and take no part. A conversation may
have no turn at all: it ends at the root. The root's row holds all
conversations. An empty table gives an empty result (no root). Other columns
play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions

CHUNK, LIST_CHUNK = 4096, 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()


def placed(rows: DataFrame, keys: list[str], order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``pos``, their number (from 1) within their keys in
    ``order``, which has to name rows apart. A range partitioning deals out the
    rows, so a key of any size is spread."""
    parts = shuffle_partitions(rows.sparkSession)
    ranged = rows.repartitionByRange(parts, *keys, *order).withColumn("part", F.spark_partition_id())
    ranged = scratch.write(ranged, name)
    sizes = ranged.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n_part"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "part", F.coalesce(F.sum("n_part").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(*keys, "part").orderBy(*order)
    return (ranged.withColumn("pos", F.row_number().over(within)).join(sizes, [*keys, "part"])
            .withColumn("pos", F.col("pos") + F.col("before")).drop("part", "before"))


def ordered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, digest, n_chars): each conversation's turns in order."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")).cast("binary"))).alias("digest"),
        F.length(text("text")).cast("long").alias("n_chars"))
    rows = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    return placed(rows, ["conv_id"], ["turn", "digest", "row"], scratch, "turns-ranged").select("conv_id", "pos", "digest", "n_chars")


def rebuilt(conversations: DataFrame, scratch: Scratch, heads: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from the first of their family:
    (conv_id, pos, digest, n_chars) and all conv_ids. The first h = crc32(id) mod
    ``heads`` turns are those of conversation c - c mod ``family``."""
    turns = scratch.write(ordered_turns(conversations, scratch), "ordered")
    c = F.col("conv_id")
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    sizes = scratch.write(sizes.select("conv_id", "n_turns", (F.crc32(c.cast("string").cast("binary")) % heads).alias("h"), (c - c % family).alias("first")), "sizes")
    firsts = sizes.select(c.alias("first"), F.col("n_turns").alias("n_first"))
    taken = sizes.join(firsts, "first", "left").withColumn("taken", F.least("h", F.coalesce("n_first", F.lit(0))))
    head = turns.where((F.col("pos") < heads) & (c % family == 0)).withColumnRenamed("conv_id", "first")
    head = sizes.select("conv_id", "first", "h").join(head, "first").where(F.col("pos") <= F.col("h")).select("conv_id", "pos", "digest", "n_chars")
    tail = (turns.join(taken.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") > F.col("h"))
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_chars"))
    return head.unionByName(tail), sizes.select("conv_id")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, n_chars, total): each prefix's name,
    the name of the one before, its last turn's and all its turns' code points."""
    step = turns.select("conv_id", F.col("pos").alias("depth"), "n_chars", F.floor((F.col("pos") - 1) / CHUNK).alias("chunk"),
                        F.xxhash64("pos", "digest").alias("x"), F.xxhash64(F.lit("second"), "digest", "pos").alias("y"))
    run = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = step.groupBy("conv_id", "chunk").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("n_chars").alias("n"))
    sums = sums.select("conv_id", "chunk", *[F.coalesce(f(v).over(before), F.lit(0).cast("long")).alias("c_" + v) for f, v in ((F.bit_xor, "x"), (F.bit_xor, "y"), (F.sum, "n"))])
    step = step.select("*", F.bit_xor("x").over(run).alias("a"), F.bit_xor("y").over(run).alias("b"), F.sum("n_chars").over(run).alias("total")).join(sums, ["conv_id", "chunk"])
    a, b = F.col("a").bitwiseXOR(F.col("c_x")), F.col("b").bitwiseXOR(F.col("c_y"))
    return step.select("conv_id", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("x")).alias("up_a"), b.bitwiseXOR(F.col("y")).alias("up_b"), "n_chars", (F.col("total") + F.col("c_n")).alias("total"))


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of lists, in order, to one row per list with its SHA-256."""
    now, state = None, None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

    def done() -> dict:
        return dict(zip(schema.names, (*now, state.hexdigest()), strict=True))

    for batch in batches:
        out = []
        for a, b, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "depth", "ids")), strict=True):
            if (a, b, depth) != now:
                if now is not None:
                    out.append(done())
                now, state = (a, b, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([done()], schema)


def ends(whole: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, depth, ends_sha256) of the ids, in ascending order and joined by
    commas, of the conversations that are exactly this sequence."""
    key = ["a", "b", "depth"]
    numbered = placed(whole.select(*key, "conv_id"), key, ["conv_id"], scratch, "whole-ranged")
    chunks = (numbered.groupBy(*key, F.floor((F.col("pos") - 1) / LIST_CHUNK).alias("chunk"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    return (chunks.repartition(shuffle_partitions(whole.sparkSession), *key).sortWithinPartitions(*key, "chunk")
            .select(*key, "ids").mapInArrow(_hash_lists, "a long, b long, depth long, ends_sha256 string"))


def trie(turns: DataFrame, conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of each node of the sequences ``turns`` (conv_id,
    pos, digest, n_chars) of all ``conversations`` (conv_id)."""
    spark, key = turns.sparkSession, ["a", "b", "depth"]
    path = scratch.write(paths(turns), "paths")
    last = path.groupBy("conv_id").agg(F.max(F.struct("depth", "a", "b", "total")).alias("e"))
    zero = F.lit(0).cast("long")
    whole = conversations.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(F.col("e")[c], zero).alias(c) for c in ("depth", "a", "b", "total")])
    whole = scratch.write(whole, "whole")
    weighted = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("w"), F.max("total").alias("end"))
    sequences = scratch.write(weighted.join(ends(whole, scratch), key), "sequences")
    # prefixes of the weighted sequences
    prefixes = path.join(sequences.select("conv_id", F.col("depth").alias("length"), "w", "end"), "conv_id")
    prefixes = scratch.write(prefixes, "prefixes")
    nodes = prefixes.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.sum("w").alias("n_convs"), F.max("n_chars").alias("n_chars"), F.max(F.col("length") > F.col("depth")).alias("inner"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"))
    nodes = scratch.write(nodes, "nodes")
    # sequences that are a proper prefix of none are leaves
    leaves = sequences.where(F.col("depth") > 0).join(nodes.where("inner").select(*key), key, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    owned = nodes.groupBy("conv_id").agg((F.min("depth") - 1).alias("o"), F.sum("n_chars").alias("own"))
    facts = sequences.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    facts = scratch.write(facts.select("conv_id", "o", F.coalesce("own", zero).alias("own"), F.coalesce("leaf", zero).alias("leaf")), "facts")
    rest = F.col("end") - F.col("total") + F.col("n_chars")
    own_rest = F.when(F.coalesce(F.col("depth") - 1 >= F.col("o"), F.lit(False)), rest).otherwise(F.col("own"))
    below = prefixes.join(facts, "conv_id").groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum(F.col("w") * rest - own_rest).alias("saved_tokens"))
    # Each node's children are counted, and one row of them is joined to it.
    up = [F.col("up_a").alias("a"), F.col("up_b").alias("b"), (F.col("depth") - 1).alias("depth")]
    children = nodes.groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    # The parent of a node that its sequence owns too has the same smallest
    # member; only a sequence's first own node needs another's.
    firsts = nodes.join(owned.select("conv_id", "o"), "conv_id")
    branch = firsts.where((F.col("depth") - 1 == F.col("o")) & (F.col("depth") > 1)).select(F.col("conv_id").alias("member"), *up)
    branch = branch.join(nodes.select(*key, F.col("conv_id").alias("parent")), key).select(F.col("member").alias("conv_id"), "parent")
    out = (nodes.select(*key, "conv_id", "n_convs").join(below, key).join(children, key, "left")
           .join(sequences.select(*key, "ends_sha256"), key, "left")
           .join(owned.select("conv_id", "o").join(branch, "conv_id", "left"), "conv_id"))
    n, smallest = whole.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    n_first, saved = nodes.agg(F.count_if(F.col("depth") == 1), F.sum((F.col("n_convs") - 1) * F.col("n_chars"))).first()
    at_root = sequences.where(F.col("depth") == 0).select("ends_sha256").first()
    root = (int(smallest or 0), 0, None, n, n_first, max(leaves.count(), 1), saved or 0, at_root[0] if at_root else NO_ENDS)
    parent = F.when(F.col("depth") == 1, F.lit(root[0])).when(F.col("depth") - 1 > F.col("o"), F.col("conv_id")).otherwise(F.col("parent"))
    out = out.select("conv_id", "depth", parent.cast("long").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    return out.unionByName(spark.createDataFrame([root] if n else [], out.schema))


def last_turns(nodes: DataFrame, turns: DataFrame, conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """``nodes`` with the role and text of their last turn (the root has none),
    found again among ``conversations`` by the turn's digest."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = conversations.select(text("role").alias("role"), text("text").alias("text"))
    named = named.withColumn("digest", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))
    named = named.groupBy("digest").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    at = nodes.join(turns.select("conv_id", F.col("pos").alias("depth"), "digest"), ["conv_id", "depth"], "left")
    return at.join(named, "digest", "left").drop("digest")
