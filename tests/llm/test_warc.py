"""WARC archives: exact round trips and the contract's rows."""

import base64
import hashlib
import io
import random

import zstandard

from quarry.llm import warc
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(rows):
    by_payload = {}
    for page_id, html in rows:
        by_payload.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for payload, ids in by_payload.items():
        first = min((i for i in ids if i is not None), default=None)
        said = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out += [(i, len(payload), said, "response" if i == first else "revisit", None if i == first else first) for i in ids]
    return sorted(out, key=repr)


def test_query(spark):
    rows = [(r.page_id, r.html) for r in table(spark, SF, "pages").collect()]
    assert sorted(map(tuple, QUERIES["op5_warc"](spark, SF).collect()), key=repr) == plain(rows)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["http://a/b c\r\nX: y", None, "", "http://é/"]), rng.choice([None, "", "same", "é" * 9, "\r\n\r\nWARC/1.1", "x" * 100_000, f"own {i}"]), "extra") for i in range(200)]
    rows += [(-7, "u", "same", None), (2**62, "u", "big", None), (-(2**63), "u", "least", None), (None, "u", "nobody", None), (None, None, "same", None), (5000, "u", "twice", None), (5000, "v", "twice", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    scratch = Scratch(spark, "t5")
    archives = warc.write_archives(pages, scratch.path("w"), scratch, archive_bytes=100_000)
    assert archives.count() > 3
    got = sorted(map(tuple, warc.read_archives(archives).collect()), key=repr)
    want = plain([(r[0], r[2]) for r in rows])
    assert got == want
    scratch = Scratch(spark, "t5")
    assert warc.read_archives(warc.write_archives(pages.limit(0), scratch.path("w"), scratch)).collect() == []


def test_archive_format():
    rng = random.Random(2)
    payloads = [("<html><body><p>" + " ".join(rng.choices(["alpha", "beta", "gamma"], k=300)) + "</p></body></html>").encode() for _ in range(400)]
    records = [warc.build_record(i, f"http://h/{i}", p, None) for i, p in enumerate(payloads)]
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out)
    for r in records:
        writer.add(r)
    writer.close()
    data = out.getvalue()
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
    assert dictionary.dict_id()
    frame = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
    assert frame.decompress(data[8 + size:]) == records[0]  # each record is a frame of its own
    assert zstandard.get_frame_parameters(data[8 + size:]).dict_id == dictionary.dict_id()
    assert list(warc.read_archive(io.BytesIO(data))) == records
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(data) < alone
    for r, p in zip(records, payloads, strict=True):
        fields, block = warc.parse_record(r)
        assert fields["WARC-Type"] == "response" and block.endswith(p) and r.endswith(b"\r\n\r\n")


def test_few_and_no_records():
    for records in ([], [warc.build_record(1, "u", b"", None)], [warc.build_record(i, "u", b"x" * i, 0) for i in range(20)]):
        out = io.BytesIO()
        writer = warc.ArchiveWriter(out)
        for r in records:
            writer.add(r)
        writer.close()
        assert list(warc.read_archive(io.BytesIO(out.getvalue()))) == records


def test_ids_survive():
    for i in (0, 1, -1, 2**63 - 1, -(2**63), 123456789012345):
        assert warc.page_of(warc.record_id(i)) == i


def test_another_attempt_leaves_written_archives_alone(spark):
    """The same pages written again in another order, as a repeated task would."""
    pages = table(spark, SF, "pages")
    scratch = Scratch(spark, "t5")
    one = warc.write_archives(pages, scratch.path("w"), scratch)
    paths = {r.path for r in one.collect()}
    other = warc.write_archives(pages.orderBy("html"), scratch.path("w"), Scratch(spark, "t5"))
    assert not paths & {r.path for r in other.collect()}
    want = plain([(r.page_id, r.html) for r in pages.collect()])
    assert all(sorted(map(tuple, warc.read_archives(m).collect()), key=repr) == want for m in (one, other))
