"""Token-id files with byte planes and a chunk index.

A file holds the ids of a run of documents. Ids are cut into blocks of a
fixed number; a block of n ids is transposed into its byte planes (all lowest
bytes, then all second bytes, ...) and each plane is a zstandard frame of its
own: the high planes of small ids are almost constant, and a plane holds bytes
of one distribution. Layout::

    "QPLANES1"
    planes of block 0, planes of block 1, ...
    zstd(chunk index: uint64 [blocks, planes] lengths of the frames)
    zstd(documents: int64 key, int64 ids, one row per document)
    footer: uint32 block ids, uint32 planes, uint64 ids, uint64 documents,
            uint64 length of the index, uint64 length of the documents, "QPLANES1"

``write_ids`` encodes documents, orders them by ``doc_id`` and writes one file
per range; ``read_ids`` gets every document's ids back from the files. The
ranges are drawn over (id, number of ids, digest of the ids, row number), so
rows of one id, however many, are spread over files in order. Each task
writes its file under a name of the range, whole or not at all, so a lost
executor's files are written again in the same form.

Null texts count as empty: such a document has the end id alone. Rows with the
same ``doc_id`` stay separate rows next to each other, ordered by their number
of ids and a digest of them. A null ``doc_id`` is written as the smallest
integer and read back as null. An empty table gives no file and no row. Other columns play no part.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, arrow_slices, atomic_file, open_fs, releasing, shuffle_partitions, texts
from quarry.llm.encode import loaded

MAGIC = b"QPLANES1"
BLOCK = 1 << 16
SLICE = 32 << 20
#: Bytes of text encoded at once; what that takes is some 20 times as much.
ENCODE_SLICE = 12 << 20
_FOOTER = struct.Struct("<IIQQQQ8s")
_NO_KEY = -(1 << 63)


def split_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The byte planes of little-endian ids."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return [np.ascontiguousarray(cells[:, p]).tobytes() for p in range(planes)]


def join_planes(planes: list[bytes]) -> np.ndarray:
    cells = np.zeros((len(planes[0]), 4), np.uint8)
    for p, plane in enumerate(planes):
        cells[:, p] = np.frombuffer(plane, np.uint8)
    return cells.reshape(-1).view("<u4")


class PlaneWriter:
    """Writes one file to a stream; holds one block of ids at a time."""

    def __init__(self, out, planes: int = 4, block: int = BLOCK, level: int = 3):
        self.out, self.planes, self.block = out, planes, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.pending: list[np.ndarray] = []
        self.held = self.total = 0
        self.index: list[int] = []
        self.docs: list[tuple[int, int]] = []
        out.write(MAGIC)

    def add(self, key: int, ids: np.ndarray) -> None:
        self.docs.append((key, len(ids)))
        self.total += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            ready = np.concatenate(self.pending)
            for at in range(0, self.held - self.held % self.block, self.block):
                self._flush(ready[at:at + self.block])
            rest = ready[self.held - self.held % self.block:]
            self.pending, self.held = [rest.copy()], len(rest)

    def _flush(self, ids: np.ndarray) -> None:
        for plane in split_planes(ids, self.planes):
            frame = self.zstd.compress(plane)
            self.index.append(len(frame))
            self.out.write(frame)

    def close(self) -> None:
        if self.held:
            self._flush(np.concatenate(self.pending))
        index = self.zstd.compress(np.asarray(self.index, "<u8").tobytes())
        docs = self.zstd.compress(np.asarray(self.docs, "<i8").tobytes())
        self.out.write(index)
        self.out.write(docs)
        self.out.write(_FOOTER.pack(self.block, self.planes, self.total, len(self.docs), len(index), len(docs), MAGIC))


class PlaneReader:
    """Random access to a file: documents by position, ids by block."""

    def __init__(self, source):
        self.source, zstd = source, zstandard.ZstdDecompressor()
        self.zstd = zstd
        size = source.size()
        source.seek(size - _FOOTER.size)
        self.block, self.planes, self.total, n_docs, n_index, n_docs_bytes, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("no token-id file")
        source.seek(size - _FOOTER.size - n_docs_bytes - n_index)
        lengths = np.frombuffer(zstd.decompress(source.read(n_index)), "<u8").reshape(-1, self.planes)
        self.docs = np.frombuffer(zstd.decompress(source.read(n_docs_bytes)), "<i8").reshape(n_docs, 2)
        self.lengths = lengths
        self.at = len(MAGIC) + np.concatenate([[0], np.cumsum(lengths.sum(axis=1))]).astype(np.int64)

    def read_block(self, i: int) -> np.ndarray:
        self.source.seek(int(self.at[i]))
        planes = [self.zstd.decompress(self.source.read(int(n))) for n in self.lengths[i]]
        return join_planes(planes)

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(key, ids before it in the file, ids) of each document in order;
        one block and one document in memory."""
        start, block, left = 0, 0, np.empty(0, "<u4")
        for key, n in self.docs.tolist():
            have = [left]
            held = len(left)
            while held < n:
                have.append(self.read_block(block))
                held += len(have[-1])
                block += 1
            all_ids = np.concatenate(have) if len(have) > 1 else left
            yield key, start, all_ids[:n]
            left, start = all_ids[n:], start + n


def encode_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(key columns of ``docs`` but ``text``, n, ids): the ids of each text and
    the end id, as a zstandard frame of little-endian 32-bit byte planes."""
    keys = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in keys] + ["n long", "ids binary"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        zstd = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in arrow_slices(batch, "text", ENCODE_SLICE):
                flat, offsets = encoder.encode(part.column("text"))
                frames, sizes = [], []
                for i in range(part.num_rows):
                    ids = np.append(flat[offsets[i]:offsets[i + 1]], np.uint32(end_id))
                    frames.append(pack_ids(ids, zstd))
                    sizes.append(len(ids))
                columns = [part.column(f.name) for f in keys] + [pa.array(sizes, pa.int64()), pa.array(frames, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in keys] + ["n", "ids"])

    return docs.mapInArrow(releasing(encode), schema)


def pack_ids(ids: np.ndarray, zstd: zstandard.ZstdCompressor) -> bytes:
    return zstd.compress(b"".join(split_planes(ids, 4)))


def unpack_ids(frame: bytes, zstd: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = zstd.decompress(frame)
    n = len(raw) // 4
    return join_planes([raw[p * n:(p + 1) * n] for p in range(4)])


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, scratch: Scratch) -> DataFrame:
    """Write the id files and return their manifest:
    (shard, path, n_docs, n_ids, start), ``start`` being the ids of all files
    before; one row per file."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_KEY))).withColumn("row", F.monotonically_increasing_id())
    # written first: the ranges are drawn from rows that stay as they are
    coded = scratch.write(encode_rows(rows, tokenizer, end_id).withColumn("digest", F.xxhash64("ids")), "coded")
    order = ["doc_id", "n", "digest", "row"]
    ordered = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "ids")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd, now, file, writer, done = zstandard.ZstdDecompressor(), None, None, None, []

        def finish():
            writer.close()
            file.__exit__(None, None, None)
            done.append((now, f"{folder}/ids-{now:06d}.qpl", len(writer.docs), writer.total))

        for batch in batches:
            for part in arrow_slices(batch, "ids", SLICE):
                for s, key, frame in zip(part.column("shard").to_pylist(), part.column("doc_id").to_pylist(), part.column("ids").to_pylist(), strict=True):
                    if s != now:
                        if file is not None:
                            finish()
                        now, file = s, atomic_file(f"{folder}/ids-{s:06d}.qpl")
                        writer = PlaneWriter(file.__enter__())
                    writer.add(key, unpack_ids(frame, zstd))
        if file is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done]) for i in range(4)], schema=_MANIFEST)

    files = scratch.write(ordered.mapInArrow(write, "shard long, path string, n_docs long, n_ids long"), "manifest")
    scratch.drop("coded")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


_MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files."""
    parts = shuffle_partitions(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = open_fs(path)
                with fs.open_input_file(name) as source:
                    rows = [(None if k == _NO_KEY else k, before + start, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")))
                            for k, start, ids in PlaneReader(source).documents()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (manifest.select("path", "start", "shard").repartition(parts, "shard")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
