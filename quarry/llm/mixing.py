"""Mixing sources to target weights by a low-discrepancy schedule.

Only DataFrame functions are used. Sources weigh ``weights`` in turn, in code
point order (a null source last), and share ``share`` times all words. A
source's target stops at ``cap`` times its size and the excess is shared again
by weight among the others, until none is above: in the order of cap / weight
the capped sources are a prefix, so one pass over running sums finds them.

The mix is a schedule of slots, each one block of ``block`` words.

* Slot j has the van der Corput point rev(j) / 2^m, the bits of j reversed.
  The sources divide [0, 1) in proportion to their numbers of blocks, and the
  slot goes to the source whose interval holds its point. Since rev is its own
  inverse, the slots are made from the sources' side: an interval's points are
  exploded in chunks and reversed. No slot is compared with all sources.
* A slot's rank among its source's slots has a closed form: for each set bit k
  of j, the smaller numbers that share j's higher bits and have bit k clear
  lie on an even grid of 2^k points, and those in an interval are counted by
  shifts. No window runs over the slots of a source.
* A source's documents are shuffled by a hash, end to end they are a stream of
  words that repeats after its end, and the stream up to the target is cut
  into blocks of equal size. Block r meets the slot of rank r in a join on
  (source, rank), whose keys are spread evenly whatever a source's share.
* Where the first slots give a source a few blocks too few (at most one per
  bit), those blocks follow at the end of the schedule; slots too many stay
  empty.

Offsets in a stream are running sums within (source, hash prefix) plus those
of the prefixes before, so a source with a third of all rows is spread over
all prefixes. The schedule grows with the input, though it is made from the
few sources' rows, so its join is told to shuffle and never broadcasts it.

A null text has size 0; a document of size 0 takes part with ``taken`` 0. Rows
that repeat a document are documents of their own. A null id is returned as
null. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions, whole_rows

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK = 1024
#: Points of the schedule that one row is exploded to.
CHUNK = 4096


@dataclass
class Mix:
    """``documents``: (doc_id, source, size, s, source_size, target, words, row,
    off), one row per document. ``pieces``: (slot, s, off, pass, words), the
    words that a slot takes of the document at ``off`` of source ``s`` in the
    given pass over the stream."""

    documents: DataFrame
    pieces: DataFrame


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> (s, source, source_size, target). One row per
    source; ``s`` is its place in code point order."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (sizes.withColumn("s", F.row_number().over(by_name) - 1)
              .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("s") % len(weights) + 1).cast("int")))
              .withColumn("most", F.col("source_size") * F.lit(float(cap))))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), "s")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (ranked.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("room", F.col("all_words") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
              .withColumn("w_left", F.sum("w").over(after))
              .withColumn("capped", F.col("most") * F.col("w_left") <= F.col("room") * F.col("w")))
    rest = (filled.withColumn("free", F.col("all_words") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(everything), F.lit(0.0)))
            .withColumn("w_free", F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)))
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.col("free") * F.col("w") / F.col("w_free"))
    return rest.select("s", "source", "source_size", target.alias("target"))


def _reversed(number: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long")


def _points_below(slot: Column, point: Column, bound: Column, bits: int) -> Column:
    """How many slots before ``slot`` (whose point is ``point``) have a point
    under ``bound``."""
    total = F.lit(0).cast("long")
    for k in range(bits):
        fixed = point.bitwiseAND(F.lit((1 << (bits - 1 - k)) - 1))
        count = F.shiftright(bound - fixed + F.lit((1 << (bits - k)) - 1), bits - k)
        inside = F.least(F.greatest(count, F.lit(0).cast("long")), F.lit(1 << k).cast("long"))
        total = total + F.when(F.shiftright(slot, k).bitwiseAND(F.lit(1).cast("long")) == 1, inside).otherwise(F.lit(0).cast("long"))
    return total


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(s, words) -> (s, rank, slot): each block of each source once."""
    cut = sources.select("s", F.ceil(F.col("words") / block).cast("long").alias("blocks"))
    n = int(cut.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0])
    bits = n.bit_length() + 1
    points = 1 << bits
    order = Window.orderBy("s")
    upto = F.sum("blocks").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = lambda c: c.cast("decimal(19,0)")  # noqa: E731  blocks times points may pass 2^63
    place = lambda c: F.call_function("div", whole(c) * whole(F.lit(points)), whole(F.lit(max(n, 1))))
    parts = (cut.withColumn("upto", upto).where("blocks > 0")
             .withColumn("low", place(F.col("upto") - F.col("blocks")))
             .withColumn("high", F.when(F.col("upto") == n, F.lit(points).cast("long")).otherwise(place(F.col("upto")))))
    chunks = (parts.where("high > low").withColumn("first", F.explode(F.sequence("low", F.col("high") - 1, F.lit(CHUNK).cast("long"))))
              .repartition(shuffle_partitions(sources.sparkSession), "s", "first")
              .withColumn("point", F.explode(F.sequence("first", F.least(F.col("first") + (CHUNK - 1), F.col("high") - 1)))))
    slots = chunks.withColumn("slot", _reversed(F.col("point"), bits)).where(F.col("slot") < n)
    rank = _points_below(F.col("slot"), F.col("point"), F.col("high"), bits) - _points_below(F.col("slot"), F.col("point"), F.col("low"), bits)
    even = slots.select("s", rank.alias("rank"), "slot", "blocks").where("rank < blocks").drop("blocks")
    end, end_point = F.lit(n).cast("long"), F.lit(int(f"{n:0{bits}b}"[::-1], 2)).cast("long")
    given = _points_below(end, end_point, F.col("high"), bits) - _points_below(end, end_point, F.col("low"), bits)
    late = (parts.withColumn("given", given).where("given < blocks")
            .withColumn("rank", F.explode(F.sequence("given", F.col("blocks") - 1)))
            .select("s", "rank", (F.lit(n) + F.col("upto") - F.col("blocks") + F.col("rank")).alias("slot")))
    return even.unionByName(late)


def mix(docs: DataFrame, scratch: Scratch, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0,
        block: int = BLOCK, seed: int = 0, prefix_digits: int = 3, row: Column | None = None) -> Mix:
    """``row`` may name the rows of ``docs``; ``documents`` then has it."""
    sized = scratch.write(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count("text").alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("key"),
        (F.lit(None).cast("long") if row is None else row).alias("row")), "sized")
    sources = scratch.write(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
                            .withColumn("words", F.floor("target")), "sources")
    named = (sized.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("prefix", F.substring("key", 1, prefix_digits)))
    within = Window.partitionBy("s", "prefix").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("s").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    before = named.groupBy("s", "prefix").agg(F.sum("size").alias("n")).select("s", "prefix", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    documents = (named.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
                 .join(before, ["s", "prefix"])
                 .select("doc_id", "source", "size", "s", "source_size", "target", "words", "row", (F.col("inner") + F.col("before")).alias("off")))
    documents = scratch.write(documents, "documents")
    passes = (documents.where("size > 0 and off < words")
              .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1 - F.col("off")) / F.col("source_size")))))
              .withColumn("start", F.col("off") + F.col("pass") * F.col("source_size"))
              .withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("words"))))
    cut = (passes.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block))))
           .withColumn("taken", F.least("stop", (F.col("rank") + 1) * block) - F.greatest("start", F.col("rank") * block))
           .select("s", "rank", "off", "pass", "taken"))
    pieces = cut.join(schedule(sources, block).hint("shuffle_merge"), ["s", "rank"]).select("slot", "s", "off", "pass", F.col("taken").alias("words"))
    return Mix(documents, pieces)


def taken(mixed: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken, slot); ``slot`` is the first of
    the schedule's slots that takes words of the document, null if none does."""
    sums = mixed.pieces.groupBy(F.col("s").alias("_s"), F.col("off").alias("_off")).agg(F.sum("words").alias("taken"), F.min("slot").alias("slot"))
    d = mixed.documents
    return (d.join(sums, (d["s"] == sums["_s"]) & (d["off"] == sums["_off"]) & (d["size"] > 0), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "slot"))


def mixed_documents(docs: DataFrame, scratch: Scratch, **settings) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document once per
    pass that takes words of it; where a pass takes only its first words (at
    the target's end), those words joined by spaces. ``n_chars`` follows the
    text. The rows come in the order of their first slots in the schedule. The rows are numbered and written first, so that rows that share an
    id, or have none, are told apart."""
    rows = scratch.write(whole_rows(docs).withColumn("number", F.monotonically_increasing_id()), "rows")
    mixed = mix(rows.select("row.doc_id", "row.source", "row.text", "number"), scratch, row=F.col("number"), **settings)
    sums = mixed.pieces.groupBy("s", "off", "pass").agg(F.sum("words").alias("words"), F.min("slot").alias("slot"))
    found = (sums.join(mixed.documents.where("size > 0").select("s", "off", F.col("row").alias("number"), "size"), ["s", "off"])
             .select("number", "size", "words", "slot"))
    first = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    row = F.col("row").withField("text", F.when(F.col("words") < F.col("size"), first).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length(row["text"]).cast(docs.schema["n_chars"].dataType))
    mixed_rows = rows.join(found.hint("shuffle_hash"), "number").select(row.alias("row"), "slot", "number")
    return mixed_rows.orderBy("slot", "number").select("row.*")
