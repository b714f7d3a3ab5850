"""PPM language identification against a plain model and held-out labels."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import language_id as li
from quarry.llm.common import table
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_bits(samples, text, order, min_count, max_nodes=10**9):
    """Code length of one text, context by context, straight from counts."""
    alphabet = sorted({b for s in samples for b in s})
    counts = {}
    for s in samples:
        for i, b in enumerate(s):
            for n in range(order + 1):
                if i >= n:
                    counts.setdefault(s[i - n:i], {}).setdefault(b, 0)
                    counts[s[i - n:i]][b] += 1

    def p(context, b):
        if context is None:
            return 1 / 257
        shorter = context[1:] if context else None
        follow = counts[context]
        n, d = sum(follow.values()), len(follow)
        if b in follow:
            return follow[b] / (n + d)
        seen = sum(p(shorter, c) for c in follow)
        return d / (n + d) * p(shorter, b) / (1 - seen)

    total = 0.0
    for i, b in enumerate(text):
        n = 0
        while n < min(order, i) and sum(counts.get(text[i - n - 1:i], {}).values()) >= min_count:
            n += 1
        total -= math.log2(p(text[i - n:i], b))
    return total


def test_code_lengths_are_the_plain_models():
    rng = random.Random(0)
    samples = {"x": [bytes(rng.choices(b"abcd ", k=300))], "y": [bytes(rng.choices(b"aabez", k=200)), b"ab" * 20]}
    for order in (0, 1, 3):
        one = {label: li.fit({label: s}, order, 3) for label, s in samples.items()}
        tests = [b"", b"a", b"abcabcde", bytes(rng.choices(b"abcdez!\xc3", k=60))]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in tests])])
        data = np.frombuffer(b"".join(tests), np.uint8)
        for label, s in samples.items():
            got = one[label].bits(data, offsets)[:, 0]
            assert got == pytest.approx([plain_bits(s, t, order, 3) for t in tests], rel=1e-5, abs=1e-6)


def test_shared_nodes_change_nothing():
    rng = random.Random(5)
    samples = {"x": [bytes(rng.choices(b"abcd ", k=900))], "y": [bytes(rng.choices(b"abcd ", weights=[5, 1, 1, 9, 2], k=900))]}
    both = li.fit(samples, 3, 1)
    text = bytes(rng.choices(b"abcd ", k=400))
    got = both.bits(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for k, label in enumerate(both.labels):
        alone = li.fit({label: samples[label]}, 3, 1)
        assert got[k] == pytest.approx(alone.bits(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0, 0], rel=1e-5)


def test_distributions_are_whole():
    trees = li.fit({"a": [b"the cat sat on the mat"], "b": [b"le chat"]}, 2, 1)
    p = np.exp2(-trees.cost.reshape(*trees.child.shape, -1).astype(float))
    p[:, -1] *= 257 - trees.child.shape[1] + 1
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_held_out_accuracy(spark):
    out = QUERIES["op3_language_id"](spark, SF)
    truth = {r.doc_id: (r.lang, r.text) for r in table(spark, SF, "documents").collect()}
    rows = out.collect()
    assert len(rows) == len(truth)
    tested = [r for r in rows if r.held_out and truth[r.doc_id][0] is not None and r.lang_pred != "und"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in tested) >= 0.97 * len(tested) > 100
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in truth[r.doc_id][1] or ""))


def test_labels_are_no_input_of_a_prediction(spark):
    docs = table(spark, SF, "documents").limit(300)
    shuffled = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'zz' else lang end as lang", "'q' as source", "n_chars")
    key = lambda df: sorted(map(tuple, li.identify(df).collect()))
    assert key(docs) == key(shuffled)


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string, held_out int"
    rows = [(i, f"the cat and the dog {i}", "en", None, 1) for i in range(20)] + [(i, f"le chat et le chien {i}", "fr", "x", 1) for i in range(20, 40)]
    rows += [(50, None, "en", None, None), (51, "", None, None, 1), (52, "123 ... \U0001f600 ½ Ⅷ _", "en", None, 1), (None, "the dog", None, None, 1), (None, None, "fr", None, 1), (3, "the cat and the dog 3", "en", None, 1), (60, "the dog " * 20000, None, None, 1)]
    docs = spark.createDataFrame(rows, schema)
    got = [(r.doc_id, r.lang_pred) for r in li.identify(docs).collect()]
    assert len(got) == len(rows)
    assert {d: p for d, p in got if d is not None}.items() >= {50: "und", 51: "und", 52: "und", 3: "en", 25: "fr", 60: "en"}.items()
    assert {p for d, p in got if d is None} == {"en", "und"}
    assert li.identify(docs.limit(0)).collect() == []
    unlabelled = docs.withColumn("lang", docs.lang.substr(0, 0)).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in li.identify(unlabelled).collect()} == {"und"}
    assert sorted(r.doc_id or -1 for r in li.with_language(docs).collect()) == sorted(d or -1 for d, p in got if p != "und")
    assert li.with_language(docs).columns == docs.columns


def test_unlabelled_tables_keep_their_documents(spark):
    rows = [(1, "clean text", None), (2, "123 ...", None), (3, None, None), (4, "", None), (None, "another \u00e9", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.text for r in li.with_language(docs).collect()) == ["another \u00e9", "clean text"]
    named = spark.createDataFrame([(i, "und und", "und") for i in range(8)], docs.schema)
    assert li.with_language(named).count() == 8


def test_empty_texts_do_not_shrink_the_sample(spark):
    rows = [(i, f"the text {i}" if i % 200 == 0 else (None if i % 2 else ""), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    every = li.training_sample(docs, F.lit(True), train_docs=20)
    assert len(every["en"]) == 20


def accuracy(trees, tests):
    data = b"".join(t for _, t in tests)
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in tests])])
    best = trees.bits(np.frombuffer(data, np.uint8), offsets).argmin(axis=1)
    return {label: np.mean([trees.labels[b] == label for b, (t, _) in zip(best, tests, strict=True) if t == label]) for label in trees.labels}


def test_labels_take_no_nodes_from_each_other():
    rng = random.Random(8)
    samples = {"big": [bytes(rng.choices(b"abcd ", k=20000))], "rare": [b"the cat and the dog " * 8]}
    both, alone = li.fit(samples, 4, 6, 150), li.fit({"rare": samples["rare"]}, 4, 6, 150)
    text = b"the dog and a cat "
    at = np.array([0, len(text)])
    # the alphabets differ, so only bytes of both are compared
    assert (both.rows[1] >= 0).all() and len(np.unique(both.rows[1])) == len(alone.code)
    assert both.bits(np.frombuffer(text, np.uint8), at)[0, 1] == pytest.approx(alone.bits(np.frombuffer(text, np.uint8), at)[0, 0], rel=1e-5)


def test_accuracy_with_a_rare_label(spark):
    by_label = {}
    for r in table(spark, SF, "documents").where("lang is not null and text <> ''").orderBy("doc_id").collect():
        by_label.setdefault(r.lang, []).append(r.text.encode())
    rare = min(by_label)
    trees = li.fit({k: v[:8 if k == rare else 60] for k, v in by_label.items()})
    got = accuracy(trees, [(k, t) for k, v in by_label.items() for t in v[60:120]])
    assert got.pop(rare) >= 0.9 and min(got.values()) >= 0.97


def test_accuracy_with_many_labels():
    rng = random.Random(4)
    samples, tests = {}, []
    for k in range(40):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 8))) for _ in range(150)]
        texts = [" ".join(rng.choices(words, k=60)).encode() for _ in range(30)]
        samples[f"l{k:02}"] = texts[:20]
        tests += [(f"l{k:02}", t) for t in texts[20:]]
    trees = li.fit(samples)
    shares = np.array([len(np.unique(r)) for r in trees.rows])
    assert shares.min() >= 0.7 * shares.max() > 200
    assert min(accuracy(trees, tests).values()) >= 0.95


def test_long_texts_in_pieces():
    text = b"the quick brown fox and the lazy dog " * 40
    trees = li.fit({"en": [text], "xx": [b"zzz yyy xxx " * 30]}, order=3, min_count=1)
    data = np.frombuffer(text + b"ab" + text[:500], np.uint8)
    offsets = np.array([0, len(text), len(text) + 2, len(data)])
    whole = trees.bits(data, offsets)
    for piece in (1, 2, 3, 7, 100, 501):
        assert trees.bits(data, offsets, piece) == pytest.approx(whole, rel=1e-9)
