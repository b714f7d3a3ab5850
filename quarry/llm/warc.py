"""WARC archives compressed record by record with an embedded dictionary.

An archive is a Zstandard file by the public WARC convention: a leading
skippable frame (magic 0x184D2A5D) holds the dictionary, itself a Zstandard
frame, and every record is a frame of its own that the dictionary primes, so a
reader can start at any record. The dictionary is built from the first records
of the archive, a bounded sample; archives with too little text for one have
an empty skippable frame and plain frames.

Of rows with equal payloads that with the smallest id is a ``response``
record, the others are ``revisit`` records that name it (WARC-Refers-To) and
hold the HTTP header only. Finding it is a sum by digest: the smallest id per
digest is pre-aggregated in each task, and rows meet it in a join whose large
side can be split where a third of all rows share a payload.

A task writes its rows to archives of about ``archive_bytes`` of payload each;
a file appears under its final name only when it is whole, so a task that runs
again replaces it.

Null html is an empty payload; empty payloads are equal to each other like any
others. A null url is written as ``urn:none``; white space and control
characters in urls are percent-encoded. Rows that share id and payload are one
page: each is written, all as the same type. Rows with a null id are one page
that comes after all others, returned as null. An empty table gives no archive
and no row. Other
columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, arrow_slices, atomic_file, open_fs, shuffle_partitions

#: Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
#: Bounds of the sample that a dictionary is built from, and of the dictionary.
SAMPLE_BYTES, SAMPLE_RECORD, DICTIONARY_BYTES = 2 << 20, 32 << 10, 64 << 10
ARCHIVE_BYTES = 64 << 20
SLICE = 8 << 20
_NO_ID = (1 << 63) - 1
_DATE = "2020-01-01T00:00:00Z"


def record_id(page_id: int) -> str:
    """A urn:uuid (custom, version 8) that holds the page's id."""
    h = f"{page_id & (1 << 64) - 1:016x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[12:15]}-8{h[15]}00-000000000000>"


def page_of(urn: str) -> int:
    h = urn.removeprefix("<urn:uuid:").removesuffix(">").replace("-", "")
    n = int(h[:12] + h[13:16] + h[17], 16)
    return n - (1 << 64) if n >> 63 else n


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "urn:none"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Target-URI: {target}", f"WARC-Date: {_DATE}",
             f"WARC-Record-ID: {record_id(page_id)}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    return fields, rest[:int(fields["Content-Length"])]


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of bounded size, or None where the samples are too few."""
    if len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples, k=512, d=8, steps=1, threads=0)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes records to one stream. Records wait until the dictionary's
    sample is full; then each goes out at once."""

    def __init__(self, out, level: int = 3):
        self.out, self.level = out, level
        self.waiting: list[bytes] | None = []
        self.waiting_bytes = self.records = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.waiting is None:
            self.out.write(self.zstd.compress(record))
            return
        self.waiting.append(record)
        self.waiting_bytes += min(len(record), SAMPLE_RECORD)
        if self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        # slices of a record: its start, which holds the headers, and the rest
        trained = build_dictionary([r[:SAMPLE_RECORD] for r in self.waiting])
        raw = trained.as_bytes() if trained else b""
        frame = zstandard.ZstdCompressor(level=self.level).compress(raw) if raw else b""
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(frame)) + frame)
        self.zstd = zstandard.ZstdCompressor(level=self.level, dict_data=trained) if trained else zstandard.ZstdCompressor(level=self.level)
        waiting, self.waiting = self.waiting, None
        for record in waiting:
            self.out.write(self.zstd.compress(record))

    def close(self) -> None:
        if self.waiting is not None:
            self._start()


def read_archive(source) -> Iterator[bytes]:
    """The records of an archive, one after another, from a stream."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    frame = source.read(size)
    known = None
    if frame:
        raw = zstandard.ZstdDecompressor().decompress(frame) if frame[:4] == ZSTD_MAGIC else frame
        known = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    held = b""
    while True:
        if not held and not (held := source.read(1 << 20)):
            return
        one, out = reader.decompressobj(), io.BytesIO()
        while not one.eof:
            if not held and not (held := source.read(1 << 20)):
                raise ValueError("archive ends within a record")
            out.write(one.decompress(held))
            held = one.unused_data if one.eof else b""
        yield out.getvalue()


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages and return (path, records), one row per archive."""
    spark = pages.sparkSession
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    first = scratch.write(rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first"), "first")
    joined = rows.join(first.withColumnRenamed("sha", "_sha").hint("shuffle_hash"), F.col("sha") == F.col("_sha"), "left").select("page_id", "url", "payload", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The attempt is part of the name: a task that runs again never touches
        # the archives that a committed manifest names.
        part = f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId():09d}"
        file = writer = None
        held, done = 0, []

        def finish():
            writer.close()
            file.__exit__(None, None, None)
            done.append((f"{folder}/part-{part}-{len(done):04d}.warc.zst", writer.records))

        for batch in batches:
            for piece in arrow_slices(batch, "payload", SLICE):
                for page_id, url, payload, first_ in zip(*(piece.column(c).to_pylist() for c in ("page_id", "url", "payload", "first")), strict=True):
                    if file is None:
                        file = atomic_file(f"{folder}/part-{part}-{len(done):04d}.warc.zst")
                        writer, held = ArchiveWriter(file.__enter__()), 0
                    writer.add(build_record(page_id, url, payload, first_ if first_ is not None and first_ != page_id else None))
                    held += len(payload)
                    if held >= archive_bytes:
                        finish()
                        file = None
        if file is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])

    return scratch.write(joined.mapInArrow(write, "path string, records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of
    every record, from the archives; a response's payload is checked against
    its digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = open_fs(path)
                out = []
                with fs.open_input_stream(name, compression=None) as source:
                    for record in read_archive(source):
                        fields, block = parse_record(record)
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                        said, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                        if kind == "response" and (len(payload) != size or digest(payload) != said):
                            raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {path}")
                        found = page_of(fields["WARC-Record-ID"])
                        refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
                        out.append((found if found != _NO_ID else None, size, said, kind, refers if refers != _NO_ID else None))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    spread = archives.select("path").repartition(shuffle_partitions(archives.sparkSession), "path")
    return spread.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
