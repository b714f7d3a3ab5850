"""Packing documents into fixed-size training sequences.

Documents are dealt to random groups (a hash of a seed and their row number in
a written copy, so that a task that runs again deals alike) and each group is
packed on its own: a group has a bounded mean number of documents whatever the
size of the table, and no key can make one large, not even that of a row that
is repeated.

Within a group a document of n ids gives floor(n / 2048) full sequences and a
remainder. The remainders are packed by first-fit decreasing: largest first,
each into the first open sequence with room for it. A tournament tree over the
sequences' free space finds that sequence in log time: an inner node holds the
most room of its two sides, and the search walks to the left side whenever
that has enough.

A sequence is padded to 2048 unless its length is a power of two. First-fit
decreasing leaves most sequences a few ids short, so a group's last step takes
the emptiest of them apart, as few as hold what the others lack: their pieces,
laid end to end, fill the gaps, and the rest is cut into whole sequences and
lengths that are powers of two. No padding is left, and only documents of the
sequences taken apart are cut.

Null texts count as empty: such a document is its end id alone. Repeated rows
are packed once each. A null id is dealt and returned as null. An empty table
gives no piece. Other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, shuffle_partitions, texts
from quarry.llm.token_files import encode_rows, unpack_ids

#: Mean number of documents in a group.
GROUP_DOCS = 512
#: Most groups, on average, that a task packs, one after another.
TASK_GROUPS = 64


class RoomTree:
    """Tournament tree over the free space of a growing list of bins."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; the bin's number."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        room[at] -= size
        found = at - self.leaves
        at //= 2
        while at:
            room[at] = max(room[2 * at], room[2 * at + 1])
            at //= 2
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of ``sizes`` by bin; ties keep their order."""
    tree, bins = RoomTree(len(sizes), capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def pack_group(lengths: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length); each id is in one."""
    out, rest = [], []
    for i, n in enumerate(lengths):
        out += [[(i, start, capacity)] for start in range(0, n - n % capacity, capacity)]
        if n % capacity:
            rest.append((i, n - n % capacity, n % capacity))
    open_bins = []
    for members in first_fit_decreasing([p[2] for p in rest], capacity):
        pieces = [rest[m] for m in members]
        total = sum(p[2] for p in pieces)
        if total == capacity or total & (total - 1) == 0:
            out.append(pieces)
        else:
            open_bins.append((total, pieces))
    open_bins.sort(key=lambda b: b[0])
    gaps = sum(capacity - total for total, _ in open_bins)
    given = apart = 0
    while given < gaps:
        total = open_bins[apart][0]
        given, gaps, apart = given + total, gaps - (capacity - total), apart + 1
    # the fullest first, whose gaps are the smallest
    wanted = [(capacity - total, pieces) for total, pieces in reversed(open_bins[apart:])]
    left = given - gaps
    wanted += [(capacity, [])] * (left // capacity)
    left %= capacity
    wanted += [(1 << b, []) for b in reversed(range(left.bit_length())) if left >> b & 1]
    pieces = (p for _, members in open_bins[:apart] for p in members)
    doc, start, have = 0, 0, 0
    for size, members in wanted:
        sequence = list(members)
        while size:
            if not have:
                doc, start, have = next(pieces)
            take = min(size, have)
            sequence.append((doc, start, take))
            start, have, size = start + take, have - take, size - take
        out.append(sequence)
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048,
         group_docs: int = GROUP_DOCS, seed: int = 0) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one
    row per piece. ``sequence_id`` is the group's number times 2^32 plus the
    sequence's number in the group."""
    given = Scratch(docs.sparkSession, "packing").write(texts(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = max(1, -(-given.count() // group_docs))
    rows = given.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups))).drop("row")
    coded = encode_rows(rows, tokenizer, end_id)

    def pack_one(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdDecompressor()
        members = [(d, n, f) for b in batches for d, n, f in zip(b.column("doc_id").to_pylist(), b.column("n").to_pylist(), b.column("ids").to_pylist(), strict=True)]
        members.sort(key=lambda m: (m[0] is None, m[0] or 0, m[1], m[2]))
        by_doc: list[list] = [[] for _ in members]
        for s, sequence in enumerate(pack_group([m[1] for m in members], capacity)):
            offset = 0
            for i, start, length in sequence:
                by_doc[i].append((start, length, s, offset))
                offset += length
        rows = []
        base = int(key[0].as_py()) << 32
        for (doc_id, n, frame), pieces in zip(members, by_doc, strict=True):
            ids = memoryview(np.ascontiguousarray(unpack_ids(frame, zstd), "<u4")).cast("B")
            rows += [(doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n, base + s, offset) for start, length, s, offset in pieces]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(len(_OUT))], names=_OUT)

    # tasks follow the number of groups, so none reads more of a larger table
    dealt = coded.repartition(max(shuffle_partitions(docs.sparkSession), -(-groups // TASK_GROUPS)), "group")
    return dealt.groupBy("group").applyInArrow(pack_one, ", ".join(f"`{c}` long" for c in _OUT))


_OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
