"""Removal of byte strings that occur more than once, by a depth-limited
radix sort of suffixes.

A suffix is a place in a text, ordered through its first ``width`` bytes (200)
only; two suffixes are equal in that order exactly if their windows of 200
bytes are equal, so the equal groups of the finished sort are the repeated
windows. The sort is most significant digit first, and a group of one leaves
it at once. Digits are strings of bytes, compared by 64-bit hashes, since only
equality is needed; a group is known by two of them, 128 bits.

* First digit: an ``anchor`` of 48 bytes. Of the places where 48 bytes fit in
  a window, the one whose first 8 bytes have the smallest hash (the leftmost
  of equals) is the window's anchor. Equal windows have equal anchors at equal
  places, and neighbouring windows mostly share one, so a run of windows, not
  each suffix, is a record of the first pass: about one in 75 places. Runs
  whose anchor occurs once are unique and leave the sort.
* Second digit: all bytes that a run's windows cover. Runs that are equal here
  are whole repeats; they are settled together and need no further pass.
* Last digit: in groups that hold different runs, one run of each kind is
  spelled out to its windows of 200 bytes, and equal ones are counted.

Counts are sums by digit, pre-aggregated in each task, and the rows of a group
are found again by joins whose large side can be split; no group is gathered.
A long text is read in pieces that overlap by a window less a byte: what a task
holds beside the text itself doesn't grow with the text, and a run that a cut
divides is two runs.

Bytes are those of the UTF-8 text. Matches never cross documents. A null text
is empty: nothing is removed. Rows that repeat a document are documents of
their own, so their texts of 200 bytes or more repeat each other: such rows are
counted first, whole texts are their spans, and one of them stands for all in
the sort. A null id is returned as null. An empty table gives an empty result.
Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.bytehash import Spans, column_bytes, mix
from quarry.llm.common import Scratch, arrow_slices, releasing, whole_rows

WIDTH = 200
ANCHOR = 48
SLICE = 2 << 20
#: Windows of one text that are looked at together.
PIECE = 2 << 20
_ORDER = np.uint64(0x9FB21C651E98DF25)


def window_anchors(data: np.ndarray, places: int) -> np.ndarray:
    """For each p the leftmost of the places p .. p + places - 1 whose first 8
    bytes have the smallest hash. ``data`` has ``places`` + 8 bytes of padding
    at its end."""
    n = len(data) - 8
    eight = np.lib.stride_tricks.as_strided(data.view(np.uint8), (n, 8), (1, 1)).copy().view("<u8").ravel()
    key = (eight * _ORDER) & np.uint64(0xFFFFFFFF00000000)
    key |= np.arange(n, dtype=np.uint64)
    rows = -(-n // places)
    padded = np.full((rows + 1) * places, ~np.uint64(0))
    padded[:n] = key
    block = padded.reshape(rows + 1, places)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - places + 1
    return (np.minimum(behind[:count], ahead[places - 1:places - 1 + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR):
    """Runs of windows that share an anchor: (row, start of the first window,
    number of windows, bytes from there to the anchor, first digit, second
    digit), starts within the row."""
    places = width - anchor + 1
    lengths = np.diff(offsets)
    windows = np.maximum(lengths - width + 1, 0)
    total = int(windows.sum())
    if not total:
        empty = np.empty(0, np.int64)
        return (empty,) * 6
    row = np.repeat(np.arange(len(lengths)), windows)
    start = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[:-1][row]
    at = window_anchors(np.concatenate([data, np.zeros(places + 8, np.uint8)]), places)[start]
    fresh = np.ones(total, bool)
    fresh[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, total))
    low, at, row = start[first], at[first], row[first]
    spans = Spans(data)
    one = spans.hash(at, at + anchor)
    two = spans.hash(low, low + count - 1 + width) ^ mix((at - low).astype(np.uint64))
    return row, low - offsets[:-1][row], count, at - low, one.view(np.int64), two.view(np.int64)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with (_key, _th), 128 bits which tell rows apart that share an
    id (or have none) but not their text, and the text as _text."""
    return (docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
            .withColumns({"_key": F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.lit("no id"), "_text")), "_th": F.xxhash64("_text")}))


def pieces(data: np.ndarray, offsets: np.ndarray, width: int, piece: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Texts of one slice as (bytes, offsets, place in the text): together, or
    a single text by ``piece`` windows at a time."""
    if len(offsets) != 2 or offsets[1] - offsets[0] <= piece + width:
        yield data, offsets, 0
        return
    text = data[offsets[0]:offsets[1]]
    for low in range(0, len(text) - width + 1, piece):
        part = text[low:low + piece + width - 1]
        yield part, np.array([0, len(part)]), low


def _run_rows(width: int, anchor: int, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "text", min(SLICE, piece)):
                for data, offsets, before in pieces(*column_bytes(part.column("text")), width, piece):
                    row, low, count, back, one, two = runs(data, offsets, width, anchor)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key").take(at), part.column("th").take(at), pa.array((low + before).astype(np.int32)), pa.array(count.astype(np.int32)),
                         pa.array(back.astype(np.int32)), pa.array(one), pa.array(two)],
                        names=["key", "th", "low", "n", "back", "one", "two"])
    return run


def _blocks(width: int, size: int):
    """Blocks of windows at like distances before the anchor, of open runs:
    ``core`` are the bytes that every window of a whole block holds, ``cover``
    those that this run's windows of it hold together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "bytes", SLICE):
                data, offsets = column_bytes(part.column("bytes"))
                spans = Spans(data)
                back, n, low = (part.column(c).to_numpy().astype(np.int64) for c in ("back", "n", "low"))
                least = back - n + 1  # the windows' distances are least .. back
                first = least // size
                per = back // size - first + 1
                row = np.repeat(np.arange(len(n)), per)
                b = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
                far, near = np.minimum(back[row], b * size + size - 1), np.maximum(least[row], b * size)
                anchor = offsets[:-1][row] + back[row]
                core = spans.hash(anchor - b * size, anchor - b * size - size + 1 + width)
                cover = spans.hash(anchor - far, anchor - near + width) ^ mix((far * 65536 + near).astype(np.uint64))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(at) for c in ("key", "th", "alone", "one")]
                    + [pa.array(low[row].astype(np.int32)), pa.array((low[row] + back[row] - far).astype(np.int32)), pa.array((far - near + 1).astype(np.int32)),
                       pa.array(far.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(cover.view(np.int64))],
                    names=["key", "th", "alone", "one", "run", "low", "n", "back", "b", "core", "cover"])
    return run


def _windows(width: int):
    """The windows of open blocks, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "bytes", SLICE):
                data, offsets = column_bytes(part.column("bytes"))
                n, back, low = (part.column(c).to_numpy().astype(np.int64) for c in ("n", "back", "low"))
                row = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = offsets[:-1][row] + i
                whole = Spans(data).hash(start, start + width)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(at) for c in ("key", "th", "alone", "one")]
                    + [pa.array((low[row] + i).astype(np.int32)), pa.array((back[row] - i).astype(np.int32)), pa.array(whole.view(np.int64))],
                    names=["key", "th", "alone", "one", "low", "back", "whole"])
    return run


def _refine(rows: DataFrame, core: list[str], cover: str, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """One pass of the sort. Only rows with equal ``core`` can repeat each
    other, and those whose ``cover`` is equal too do. Returns the rows that do,
    and one row of each kind in the groups of several kinds; ``alone`` tells
    whether it is still to be settled."""
    payload = [c for c in rows.columns if c not in (*core, cover)]
    kinds = scratch.write(rows.groupBy(*core, cover).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*payload)).alias("_row")), f"{name}-kinds")
    several = scratch.write(kinds.groupBy(*core).agg(F.count(F.lit(1)).alias("_k")).where("_k > 1").select(*core), f"{name}-several")
    done = rows.join(kinds.where("_n > 1").select(*core, cover), [*core, cover], "left_semi").where("alone")
    open_ = (kinds.join(several, core, "left_semi").select(*core, "_row.*", "_n")
             .withColumn("alone", F.col("alone") & (F.col("_n") == 1)).drop("_n"))
    return done, open_


def _with_bytes(docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with the bytes that their windows cover. The rows of one
    document travel to its text as a list, at most as long as the text."""
    lists = rows.groupBy("key", "th").agg(F.collect_list(F.struct(*[c for c in rows.columns if c not in ("key", "th")])).alias("_rows"))
    found = (docs.select(F.col("_key").alias("key"), F.col("_th").alias("th"), F.col("_text").cast("binary").alias("_data"))
             .join(lists.hint("shuffle_hash"), ["key", "th"])
             .select("key", "th", "_data", F.explode("_rows").alias("_r")))
    covered = F.substring("_data", F.col("_r.low") + 1, F.col("_r.n") + (width - 1))
    return found.select("key", "th", "_r.*", covered.alias("bytes"))


def repeated_rows(docs: DataFrame) -> DataFrame:
    """(key, th, bytes) of the rows of ``docs`` (as of ``keyed``) that are there
    more than once."""
    return (docs.groupBy(F.col("_key").alias("key"), F.col("_th").alias("th"))
            .agg(F.count(F.lit(1)).alias("_n"), F.max(F.octet_length("_text")).alias("bytes")).where("_n > 1").drop("_n"))


def one_of_each(docs: DataFrame, again: DataFrame) -> DataFrame:
    """(_key, _th, _text), one row of each kind; ``again`` as of
    ``repeated_rows``. Only texts of those are aggregated, in the tasks first."""
    keys = again.select(F.col("key").alias("_key"), F.col("th").alias("_th"))
    docs = docs.select("_key", "_th", "_text")
    return docs.join(keys, ["_key", "_th"], "left_anti").union(
        docs.join(keys, ["_key", "_th"], "left_semi").groupBy("_key", "_th").agg(F.first("_text").alias("_text")))


def repeated_spans(docs: DataFrame, scratch: Scratch, width: int = WIDTH, anchor: int = ANCHOR, block: int = 8, piece: int = PIECE) -> DataFrame:
    """``docs`` as of ``keyed`` -> (key, th, low, high): the bytes low ..
    high - 1 are covered by repeated windows. Spans may touch and overlap; those
    of rows that are there more than once are given once.

    Each pass writes what the next ones need and drops what they don't. Counts
    are written before they are joined to the rows they count: a join of two
    plain tables is split where a digit is very common."""
    def spans(rows: DataFrame, name: str) -> DataFrame:
        return scratch.write(rows.select("key", "th", "low", (F.col("low") + F.col("n") - 1 + width).alias("high")), name)

    twice = scratch.write(repeated_rows(docs), "repeated-rows")
    whole_rows_ = twice.where(F.col("bytes") >= width).select("key", "th", F.lit(0).alias("low"), F.col("bytes").alias("high"))
    docs = one_of_each(docs, twice)
    runs_ = docs.select(F.col("_key").alias("key"), F.col("_th").alias("th"), F.col("_text").alias("text"))
    records = scratch.write(runs_.mapInArrow(releasing(_run_rows(width, anchor, piece)), "key long, th long, low int, n int, back int, one long, two long"), "records")
    again = scratch.write(records.groupBy("one").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("one"), "again")
    shared = scratch.write(records.join(again, "one", "left_semi").withColumn("alone", F.lit(True)), "shared")
    scratch.drop("records", "again")
    done, open_ = _refine(shared, ["one"], "two", scratch, "runs")
    whole_runs = spans(done, "whole-runs")
    open_runs = scratch.write(_with_bytes(docs, open_, width), "open-runs")
    scratch.drop("shared", "runs-kinds", "runs-several")

    schema = "key long, th long, alone boolean, one long, run int, low int, n int, back int, b int, core long, cover long"
    blocks = scratch.write(open_runs.mapInArrow(_blocks(width, block), schema), "blocks")
    done, open_ = _refine(blocks, ["one", "b", "core"], "cover", scratch, "blocks")
    whole_blocks = spans(done, "whole-blocks")
    run = [F.col(c).alias(f"_{c}") for c in ("key", "th", "low", "bytes")]
    held = (open_.join(open_runs.select(*run), (F.col("key") == F.col("_key")) & (F.col("th") == F.col("_th")) & (F.col("run") == F.col("_low")))
            .withColumn("bytes", F.substring("_bytes", F.col("low") - F.col("run") + 1, F.col("n") + (width - 1))))
    schema = "key long, th long, alone boolean, one long, low int, back int, whole long"
    windows = scratch.write(held.select("key", "th", "alone", "one", "low", "n", "back", "bytes").mapInArrow(_windows(width), schema), "windows")
    scratch.drop("open-runs", "blocks", "blocks-kinds", "blocks-several")

    digits = ["one", "back", "whole"]
    equal = scratch.write(windows.groupBy(*digits).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*digits), "equal")
    single = spans(windows.where("alone").join(equal, digits, "left_semi").withColumn("n", F.lit(1)), "single-windows")
    scratch.drop("windows", "equal")
    return whole_runs.union(whole_blocks).union(single).union(whole_rows_)


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Touching and overlapping spans as maximal ones, in order."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    fresh = np.ones(len(low), bool)
    fresh[1:] = low[1:] > high[:-1]
    first = np.flatnonzero(fresh)
    return low[first], high[np.append(first[1:], len(low)) - 1] if len(first) else high


def remove(docs: DataFrame, spans: DataFrame, columns: list[str], keep_text: bool = False) -> DataFrame:
    """``columns`` of ``docs`` (as of ``keyed``), with (_n_bytes, _n_removed,
    _n_spans, _sha256) and, if asked for, the remaining text as _kept."""
    lists = spans.groupBy(F.col("key").alias("_k"), F.col("th").alias("_t")).agg(F.collect_list(F.struct("low", "high")).alias("_spans"))
    joined = docs.join(lists.hint("shuffle_hash"), (F.col("_key") == F.col("_k")) & (F.col("_th") == F.col("_t")), "left").select(*columns, "_text", "_spans")
    kept = [f for f in joined.schema.fields if f.name in columns]
    names = ["_n_bytes", "_n_removed", "_n_spans", "_sha256"] + ["_kept"] * keep_text
    schema = StructType([*kept]).add("_n_bytes", "long").add("_n_removed", "long").add("_n_spans", "long").add("_sha256", "string")
    schema = schema.add("_kept", "string") if keep_text else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "_text", 4 * SLICE):
                out = []
                for text, found in zip(part.column("_text").cast(pa.large_binary()), part.column("_spans"), strict=True):
                    data, removed, low = memoryview(text.as_buffer()), 0, ()
                    left = [data]
                    if found.is_valid:
                        spans_ = found.values
                        low, high = merged(spans_.field("low").to_numpy().astype(np.int64), spans_.field("high").to_numpy().astype(np.int64))
                        removed = int((high - low).sum())
                        left = [data[a:b] for a, b in zip(np.append(0, high), np.append(low, len(data)), strict=True)]
                    sha = hashlib.sha256()
                    for piece in left:
                        sha.update(piece)
                    out.append((len(data), removed, len(low), sha.hexdigest(), b"".join(left).decode(errors="ignore") if keep_text else None))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + [pa.array([o[i] for o in out], types[i]) for i in range(len(names))], names=[f.name for f in kept] + names)

    return joined.mapInArrow(releasing(run), schema)


def remove_repeats(docs: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    given = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")
    out = remove(given, repeated_spans(given, scratch, width), ["doc_id"])
    return out.select("doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"), F.col("_n_spans").alias("n_spans"), F.col("_sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated bytes cut out of their texts (characters
    that a cut splits go whole); ``n_chars`` follows the text."""
    row = F.col("row")
    given = keyed(whole_rows(docs).select(row.withField("text", F.lit(None).cast("string")).alias("row"), "row.doc_id", "row.text"))
    out = remove(given, repeated_spans(given, scratch, width), ["row"], keep_text=True)
    row = row.withField("text", F.col("_kept"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("_kept").cast(docs.schema["n_chars"].dataType))
    return out.select(row.alias("row")).select("row.*")
