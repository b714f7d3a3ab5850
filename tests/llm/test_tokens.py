"""Token counts, token-id files and packing against the libraries themselves."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import packing, token_counts, token_files
from quarry.llm.common import Scratch, table
from quarry.llm.encode import Encoder, vocabulary
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", " a", "a ", "  a  b ", "a\n b", "a\n\nb\n", "x <|endoftext|> y<|startoftext|>z", "don't I'll  've 's",
       "éb ́", "Á É ǅ ß Σας", "it 1234 x2y3 7", "q\t \n", '"hi," (x)', "　x y", "x　 y", "... , a",
       "a\x1cb \x85c", "<0x41> <s>", "▁a ▁", "naïve, façade; über-x", "\U0001f600 ok\U0001f600", "a<b", "tab\tsep"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(100, None, None, None), (7, "again the same", "x", 2), (7, "again the same", "x", 2), (None, "no id here", None, None), (-5, "word " * 9000, "y", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n long")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_are_the_librarys(spark, name):
    texts = ODD + [r.text for r in table(spark, SF, "documents").collect()]
    encoder = Encoder(vocabulary(name), cache_pieces=500)
    for _ in range(2):
        flat, offsets = encoder.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert flat[offsets[i]:offsets[i + 1]].tolist() == encoder.tok.encode(text, add_special_tokens=False).ids, text[:80]


def test_piece_counts_are_the_librarys(spark):
    texts = ODD + [r.text for r in table(spark, SF, "documents").collect()]
    counter = token_counts.PieceCounter(vocabulary("piece_bpe_32k.model"))
    assert counter.by_word
    assert counter.count(pa.array(texts)).tolist() == [len(counter.model.encode(t)) for t in texts]


def test_counts_with_cache(spark, docs):
    scratch, model = Scratch(spark, "t9"), vocabulary("piece_bpe_32k.model")
    cache = scratch.path("cache")
    first = token_counts.token_counts(docs, model, cache, scratch, limit=50)
    counter = token_counts.PieceCounter(model)
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), n, n > 50) for r in docs.collect() for n in [len(counter.model.encode(r.text or ""))])
    key = lambda df: sorted((r[0] is None, r[0] or 0, *r[1:]) for r in df.collect())
    assert key(first) == want
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count()
    more = docs.where("doc_id < 5").union(spark.createDataFrame([(900, "only this is new", "", 0)], docs.schema))
    before, n = stored.count(), more.count()
    assert token_counts.token_counts(more, model, cache, Scratch(spark, "t9"), limit=50).count() == n
    assert spark.read.parquet(cache).count() == before + 1
    assert token_counts.token_counts(docs.limit(0), model, Scratch(spark, "t9").path("cache"), Scratch(spark, "t9")).collect() == []


def test_plane_files_round_trip():
    rng = np.random.default_rng(0)
    docs = [(i, rng.integers(0, 2**32 if i % 3 else 40000, n, dtype=np.uint32)) for i, n in enumerate([0, 1, 15, 16, 17, 100, 0, 33])]
    out = io.BytesIO()
    writer = token_files.PlaneWriter(out, block=16)
    for key, ids in docs:
        writer.add(key, ids)
    writer.close()
    reader = token_files.PlaneReader(pa.BufferReader(out.getvalue()))
    start = 0
    for (key, ids), (k, s, got) in zip(docs, reader.documents(), strict=True):
        assert (k, s) == (key, start) and got.tolist() == ids.tolist()
        start += len(ids)
    assert reader.total == start and len(reader.lengths) == -(-start // 16)


def test_id_files(spark, docs):
    scratch, name = Scratch(spark, "t6"), vocabulary("word_bpe_49k.json")
    got = token_files.read_ids(token_files.write_ids(docs, scratch.path("ids"), name, 2, scratch)).collect()
    encoder = Encoder(name)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())) for r in docs.collect()
                   for ids in [encoder.tok.encode(r.text or "", add_special_tokens=False).ids + [2]]), key=lambda r: r[:2])
    assert [(r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in sorted(got, key=lambda r: r.start)] == rows
    assert [r.start for r in sorted(got, key=lambda r: r.start)] == [sum(x[2] for x in rows[:i]) for i in range(len(rows))]
    scratch = Scratch(spark, "t6")
    assert token_files.read_ids(token_files.write_ids(docs.limit(0), scratch.path("ids"), name, 2, scratch)).collect() == []


def check_packing(rows, docs, encoder, end_id, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for r in docs:
        ids = np.asarray(encoder.tok.encode(r.text or "", add_special_tokens=False).ids + [end_id], "<u4")
        at = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)


def test_packing_query(spark):
    docs = table(spark, SF, "documents")
    check_packing(QUERIES["op10_packing"](spark, SF).collect(), docs.collect(), Encoder(vocabulary("byte_bpe_50k.json")), 1, 2048)


def test_packing_edges(spark, docs):
    name = vocabulary("byte_bpe_50k.json")
    unique = docs.where("doc_id is null or doc_id <> 7")
    check_packing(packing.pack(unique, name, 1, capacity=64, group_docs=4).collect(), unique.collect(), Encoder(name), 1, 64)
    assert packing.pack(docs, name, 1).where("doc_id = 7 and start = 0").count() == 3
    assert packing.pack(docs.limit(0), name, 1).collect() == []


def test_first_fit_decreasing_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(30):
        sizes = [rng.randint(1, 99) for _ in range(rng.randint(0, 60))]
        plain, room = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            at = next((b for b, r in enumerate(room) if r >= sizes[i]), len(room))
            if at == len(room):
                room.append(100)
                plain.append([])
            room[at] -= sizes[i]
            plain[at].append(i)
        assert packing.first_fit_decreasing(sizes, 100) == plain


def test_queries_give_one_row_per_document(spark):
    n = table(spark, SF, "documents").count()
    assert QUERIES["op6_token_files"](spark, SF).count() == n
    assert QUERIES["op9_token_counts"](spark, SF).count() == n


def test_rows_of_one_id_are_spread_over_files(spark):
    scratch = Scratch(spark, "t6")
    docs = spark.range(2000).selectExpr("cast(if(id % 2 = 0, null, 7) as long) doc_id", "if(id % 3 = 0, null, 'same') text")
    manifest = token_files.write_ids(docs, scratch.path("ids"), vocabulary("word_bpe_49k.json"), 2, scratch)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 2000 and max(sizes) < 700
    rows = sorted(token_files.read_ids(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None] * 1000 + [7] * 1000
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(2000)]


def test_repeated_rows_are_dealt_to_many_groups(spark):
    docs = spark.range(2000).selectExpr("cast(null as long) doc_id", "if(id % 2 = 0, null, 'same') text")
    rows = packing.pack(docs, vocabulary("byte_bpe_50k.json"), 1, capacity=64, group_docs=50).collect()
    groups = {}
    for r in rows:
        if r.start == 0:
            groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert sum(groups.values()) == 2000 and len(groups) == 40 and max(groups.values()) < 120


def test_few_packed_remainders_are_cut():
    rng = random.Random(2)
    for draw in (lambda: rng.randint(1, 99), lambda: rng.randint(1, 400), lambda: max(1, int(rng.lognormvariate(3, 1)))):
        lengths = [draw() for _ in range(512)]
        out = packing.pack_group(lengths, 100)
        pieces = sorted(p for s in out for p in s)
        at = [0] * len(lengths)
        for i, start, n in pieces:
            assert start == at[i] and n > 0
            at[i] += n
        assert at == lengths
        totals = [sum(n for _, _, n in s) for s in out]
        assert all(t == 100 or t & (t - 1) == 0 for t in totals) and sum(t < 100 for t in totals) <= 9
        whole = sum(n // 100 + (n % 100 > 0) for n in lengths)
        last = [0] * len(lengths)
        for i, start, _ in pieces:
            last[i] += start >= lengths[i] - lengths[i] % 100
        assert len(pieces) >= whole and sum(n > 1 for n in last) <= 512 // 16


def test_odd_texts_by_the_dozen():
    """Marks of the model's own, odd spaces, control and format characters, combining signs."""
    rng = np.random.default_rng(11)
    parts = ["a", "The", " ", " ", "  ", "▁", "中", "é", "e\u0301", "\u00a0", "\u2003", "\u3000", "\n", "\t", "\r\n", "\u200b", "\ufeff", "\x00", "\x7f", "\u00ad", "´", "¨", "ﬁ", "１", "😀", "👩\u200d💻", "<s>", "</s>", "<unk>", ".", "12", "ing", "\u0301", "ͺ", "ا", "한", "\u1100\u1161", "Ǆ", "\u2028", "\x85", "-", "'s"]
    texts = ["".join(rng.choice(parts, size=rng.integers(1, 12))) for _ in range(20_000)] + ["a▁ 中", "▁ ▁", " ▁a"]
    counter = token_counts.PieceCounter(vocabulary("piece_bpe_32k.model"))
    got = counter.count(pa.array(texts, pa.string()))
    want = [len(counter.model.encode(t, add_bos=False, add_eos=False)) for t in texts]
    assert [t for t, g, w in zip(texts, got.tolist(), want, strict=True) if g != w] == []
