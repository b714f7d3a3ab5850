"""Personal data: patterns against plain ones, the random field against brute
force and on sentences that it was not trained on."""

import hashlib
import itertools
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pii
from quarry.llm.common import table
from quarry.llm.queries import QUERIES

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(sum(divmod(d, 10)) for d in doubled) % 10 == 0


def plain(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.text("a1@.+- ()0_%9é\n:", max_size=60))
def test_patterns(text):
    assert pii.pattern_spans(text) == plain(text)


def test_patterns_of_numbers():
    rng = np.random.default_rng(1)
    found = 0
    for _ in range(3000):
        text = "".join(rng.choice(["4", "0", "12", "255", "256", " ", "-", ".", "+1", "(", ") ", "4111 1111 1111 1111", "a@b", "c.d", "x"], size=rng.integers(1, 14)))
        assert pii.pattern_spans(text) == plain(text), text
        found += len(plain(text))
    assert found > 500


def test_viterbi_and_batches():
    rng = np.random.default_rng(0)
    field = pii.Field(rng.normal(size=(2 * pii.REACH + 1, 2 * pii.SHAPES, pii.LABELS)), rng.normal(size=(4, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), rng.normal(size=pii.LABELS))
    s = pii.sentences("call +1 2\nx\nat 3", every=True)
    seen = 0
    for _firsts, lengths, shape, cue in pii._batches(s, cells=8):
        scores = field.scores(shape, pii._before(cue))
        got = pii.viterbi(field, scores, lengths)
        for i, n in enumerate(lengths):
            def total(path):
                return field.first[path[0]] + sum(scores[i, t, y] for t, y in enumerate(path)) + sum(field.pair[a, b] for a, b in itertools.pairwise(path))
            assert tuple(got[i, :n]) == max(itertools.product(range(pii.LABELS), repeat=int(n)), key=total)
            seen += n
    assert seen == len(s.start) == 7


HELD_OUT = """\
You may dial <phone>(202) 555-0191</phone> before noon.
Unser Fax: <phone>089/5550123</phone> bitte
the other line, <phone>718-555-0166</phone>, is new
ask <email>peter at school dot org</email> first
mail <email>lena [at] web [dot] de</email>
we saw <ip>198[.]51[.]100[.]7</ip> again
host <ip>2001:db8:0:0:1:0:0:1</ip> is up
visa <card>4242.4242.4242.4242</card> declined
The year 2021 had 365 days, 2020 had 366.
It was 12.50 at noon, 9.75 at 10:45 and 3 later.
commit 8f14e45fceea167a5a36dedd4bea2543 of 2024-01-31
He sat at the table and drew a dot.
Orders 55501 and 55502, 17 items each
thble 8800112233445566 ander 17.12.2003
""".splitlines()


def test_held_out_sentences():
    field = pii.trained()
    wanted = pii.read_labelled(HELD_OUT)
    got = [pii.decoded_spans(field, text) for text, _ in wanted]
    right = sum(len(set(g) & set(w)) for g, (_, w) in zip(got, wanted, strict=True))
    assert right >= 7 and sum(map(len, got)) - right == 0
    trained_on = pii.read_labelled(pii.LABELLED)
    assert sum(pii.decoded_spans(field, t) == s for t, s in trained_on) >= 0.95 * len(trained_on)


def test_texts_are_decoded_apart():
    field, texts = pii.trained(), ["call (415) 555", "0132 (415) 555-0132", "", "x at y dot com\n\n", "+1 (017) 555-7713 47361"]
    assert pii.all_spans(field, texts) == [pii.all_spans(field, [t])[0] for t in texts]
    assert pii.all_spans(field, texts)[4] == [(0, 3, 17, False)]  # the pattern's match has too many digits
    for _text, spans in zip(texts, pii.all_spans(field, texts), strict=True):
        assert all(a[2] <= b[0] or a[3] and b[3] for a, b in itertools.pairwise(spans))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = QUERIES["op13_pii"](spark, sf).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 20
    for r in rows:
        base = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain(docs[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]
        assert set(base) <= set(filter(None, r.spans.split(",")))


def test_odd_rows(spark):
    rows = [(1, None, 3), (None, "mail a@b.co", 3), (1, None, 3), (2, "", 3), (3, "call (415) 555-0132 or +1 415 555 0132", 3), (3, "call (415) 555-0132 or +1 415 555 0132", 3), (4, "😀 a@b.co 😀", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = pii.find(frame, redacted=True)
    assert got.columns == ["doc_id", "spans", "redacted"]
    got = sorted(((r.doc_id, [tuple(s) for s in r.spans], r.redacted) for r in got.collect()), key=str)
    phones = [("phone", 5, 19, False), ("phone", 23, 38, True)]
    assert got == sorted([(1, [], None)] * 2 + [(None, [("email", 5, 11, True)], "mail [email]"), (2, [], ""), (4, [("email", 2, 8, True)], "😀 [email] 😀")] + [(3, phones, "call [phone] or [phone]")] * 2, key=str)
    assert pii.find(frame.limit(0)).count() == 0
    kept = pii.find(frame.withColumnRenamed("spans", "c0"), keep=("doc_id", "c0"))
    assert kept.columns == ["doc_id", "c0", "spans"] and kept.count() == 7


def test_very_long_texts(spark):
    began = time.time()
    for long in ("a" * 500_000, "1" * 500_000, "1." * 250_000, "+1 " * 75_000, "a.b@" * 75_000, "+1" + " " * 500_000, "x" * 250_000 + "@y"):
        text = "(415) 555-0132\n" + long + "\na@b.co"
        spans = pii.all_spans(pii.trained(), [text])[0]
        assert (0, 3, 14, False) in spans and (len(text) - 6, 0, len(text), True) in spans
    assert time.time() - began < 60
