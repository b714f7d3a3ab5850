"""Near-duplicates against all pairs on small tables."""

import random
import re

import numpy as np
import pyarrow as pa

from quarry.llm import bytehash
from quarry.llm import near_dedup as nd
from quarry.llm.common import Scratch, table
from quarry.llm.graph import components
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_set(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not found:
        return set()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))}


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def plain(rows, words=4, percent=80):
    sets = {d: plain_set(t, words) for d, t in rows}
    ids, index = sorted(sets), {}
    for d, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(d)
    pairs = {(a, b) for ds in index.values() for a in ds for b in ds if a < b}
    links = [(a, b) for a, b in pairs if 100 * (n := len(sets[a] & sets[b])) >= percent * (len(sets[a]) + len(sets[b]) - n)]
    return {d: (len(sets[d]), c, d == c) for d, c in plain_components(ids, links).items()}


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op4_near_dedup"](spark, SF).collect()}
    want = plain(rows)
    assert got == want
    assert sum(not v[2] for v in want.values()) > 20


def test_chains_groups_and_odd_rows(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, n = [], 0
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(3, 120))
        for _ in range(rng.randint(1, 25)):
            text = list(base)
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            base = text if rng.random() < 0.5 else base
            rows.append((n, " \t".join(text).upper() if n % 3 else " ".join(text)))
            n += 1
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows += [(n + i, passage + " " + " ".join(rng.choices(vocabulary, k=60))) for i in range(40)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "ONE"), (505, "one two"), (506, "two one"), (507, "one two"), (508, "É é"), (509, "é é"), (-4, "x " * 20000), (510, "x " * 30000)]
    rng.shuffle(rows)
    schema = "doc_id long, text string, bands string, component string"
    docs = spark.createDataFrame([(*r, None, "c") for r in rows], schema)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(docs, Scratch(spark, "t4"), words=4, part_rows=4).collect()}
    assert got == plain(rows)
    extra = spark.createDataFrame([(503, "one", None, None), (None, "one two", None, None), (None, None, None, None)], schema)
    out = nd.near_duplicates(docs.union(extra), Scratch(spark, "t4"), words=4).collect()
    assert len(out) == len(rows) + 3
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None and r.n_shingles] == [(505, False)]
    assert nd.near_duplicates(docs.limit(0), Scratch(spark, "t4")).collect() == []


def test_mixed_buckets_are_searched_again(spark):
    """One band only: every member meets the smallest first, then the rest."""
    base = [f"a{i}" for i in range(100)]
    docs = [(0, base[:70] + [f"b{i}" for i in range(40)]), (1, base), (2, base + ["c"]), (3, base + ["c", "d"])]
    rows = [(i, " ".join(t)) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for bands, n in ((1, 1), (40, 1)):
        got = {r.doc_id: r.component_id for r in nd.near_duplicates(frame, Scratch(spark, "t4"), words=4, bands=bands, rows=n).collect()}
        if bands == 40:
            assert got == {d: v[1] for d, v in plain(rows).items()}


def plain_signature(elements, cells):
    out = [(1 << 64) - 1] * cells
    for e in elements:
        places = list(range(cells))
        for step in range(cells):
            drawn = int(bytehash.mix(np.array([e], np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))[0])
            other = step + ((drawn & 0xFFFFFFFF) * (cells - step) >> 32)
            places[step], places[other] = places[other], places[step]
            out[places[step]] = min(out[places[step]], step << 32 | drawn >> 32)
    return out


def test_signatures_are_super_minhash():
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 5, 30, 200, 0, 7]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    elements = rng.integers(0, 1 << 64, offsets[-1], dtype=np.uint64)
    got = nd.super_minhash(elements, offsets, 16)
    for i in range(len(sizes)):
        assert got[i].tolist() == plain_signature(elements[offsets[i]:offsets[i + 1]].tolist(), 16)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        common, own = rng.integers(0, 1 << 64, 80, dtype=np.uint64), rng.integers(0, 1 << 64, 20, dtype=np.uint64)
        elements = np.concatenate([common, own[:10], common, own[10:]])
        s = nd.super_minhash(elements, np.array([0, 90, 180]), 112)
        errors.append((s[0] == s[1]).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.015


def test_shingles_are_the_plain_ones():
    rng = random.Random(9)
    rows = ["", " ", "a", "a b", "A\x0bb\x0cc", "a b c d e", "a b c d a b c d", "ÀB c d É", "  lead and trail  "] + [" ".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(50)]
    hashes, offsets = bytehash.shingles(*bytehash.column_bytes(pa.array(rows)), 4)
    known = {}
    for i, r in enumerate(rows):
        want = plain_set(r)
        have = hashes[offsets[i]:offsets[i + 1]].tolist()
        assert len(have) == len(want) == len(set(have))
        known.setdefault(frozenset(want), set()).add(tuple(have))
    assert all(len(v) == 1 for v in known.values()) and len({v for s in known.values() for v in s}) == len(known)


def test_components_of_paths_and_stars(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links + [(None, 3), (4, None)], "a long, b long").repartition(8)
    got = {r.node: r.component for r in components(frame, Scratch(spark, "cc")).collect()}
    want = plain_components({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}


def test_rows_without_ids_link(spark):
    base = [f"w{i}" for i in range(200)]
    near = [f"y{i}" if i == 30 else w for i, w in enumerate(base)]
    third = [f"z{i}" if i == 150 else w for i, w in enumerate(base)]
    apart = [f"q{i}" for i in range(50)]
    rows = [(None, " ".join(t)) for t in (base, near, third, third, apart)] + [(None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(frame, Scratch(spark, "t4"))
    assert [(r.doc_id, r.component_id, r.kept) for r in got.collect()] == [(None, None, True)] * 6
    kept = [r.text for r in nd.first_of_each(frame, Scratch(spark, "t4")).collect()]
    assert None in kept and " ".join(apart) in kept and len(set(kept)) == 3  # one text of the group stays
    with_id = frame.union(spark.createDataFrame([(7, " ".join(base))], frame.schema))
    got = {(r.doc_id, r.component_id) for r in nd.near_duplicates(with_id, Scratch(spark, "t4")).where("n_shingles = 196").collect()}
    assert got == {(None, 7), (7, 7)}
    assert sorted(r.doc_id or 0 for r in nd.first_of_each(with_id, Scratch(spark, "t4")).collect()) == [0, 0, 7]
