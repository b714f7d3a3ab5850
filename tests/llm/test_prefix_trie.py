"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np

from quarry.llm import prefix_trie as pt
from quarry.llm.common import Scratch, table
from quarry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(first, [])[:h] + turns[h:]
    return out


def plain(rows):
    convs = plain_rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(k[:-1] for k in members if k)
    saved, leaves = Counter(), Counter()
    for k, who in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(who) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += children[k] == 0
    out = []
    for k, who in members.items():
        here = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(k))))
        out.append((min(who), len(k), min(members[k[:-1]]) if k else None, len(who), children[k], leaves[k], saved[k], hashlib.sha256(here.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, schema=SCHEMA):
    scratch = Scratch(spark, "t12")
    return pt.trie(*pt.rebuilt(spark.createDataFrame(rows, schema), scratch), scratch)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op12_prefix_trie"](spark, sf)
    assert dict(got.dtypes) == {c: "string" if c == "ends_sha256" else "bigint" for c in COLUMNS}
    assert rows_of(got) == plain([tuple(r) for r in table(spark, sf, "conversations").collect()])


def test_odd_rows_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 3)
    monkeypatch.setattr(pt, "LIST_CHUNK", 4)
    rng = np.random.default_rng(2)
    words = ["a", "bé", "", None, "😀x"]
    rows = []
    for c in [*range(0, 20), *range(100, 130), *range(-130, -95), *range(550, 566), 700]:
        for turn in range(int(rng.integers(1, 9)) if c < 550 else 2):
            rows.append((c, turn if rng.random() < 0.95 else None, ["user", None][int(rng.integers(2))], words[int(rng.integers(len(words)))]))
    rows += rows[::9] + [(3, 1, "user", "a")] * 5 + [(None, 0, "user", "a"), (900, None, None, None)]
    assert any(not t for t in plain_rebuilt(rows).values())  # a conversation may lose all turns
    assert rows_of(found(spark, rows)) == plain(rows)


def test_hot_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 100)
    rows = [(201, i, "user", f"t{i % 7}") for i in range(1500)]
    rows += [(c, i, "user", f"s{i}") for c in range(1000, 1400) for i in range(3)]
    rows += [(c, 0, "user", "x") for c in range(2000, 2050)]
    assert rows_of(found(spark, rows)) == plain(rows)


def test_empty_and_single(spark):
    assert rows_of(found(spark, [])) == []
    assert rows_of(found(spark, [(None, 1, "user", "x")])) == []
    c = next(c for c in range(550, 575) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, None, "x"), (c, 1, None, "y")]
    assert rows_of(found(spark, rows)) == plain(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_other_columns_and_last_turns(spark):
    rows = [(100 + i, j, "u", f"{j}-{i % 2}") for i in range(6) for j in range(4)]
    clashing = ", ".join(f"{c} int" for c in ("pos", "digest", "part", "row", "depth", "n_chars", "first", "h"))
    scratch, frame = Scratch(spark, "t12"), spark.createDataFrame([(*r, *range(8)) for r in rows], f"{SCHEMA}, {clashing}")
    turns, convs = pt.rebuilt(frame, scratch)
    nodes = scratch.write(pt.trie(turns, convs, scratch), "nodes-out")
    assert rows_of(nodes) == plain(rows)
    named = pt.last_turns(nodes, turns, frame, scratch).collect()
    built = plain_rebuilt(rows)
    assert all((r.role, r.text) == (built[r.conv_id][r.depth - 1] if r.depth else (None, None)) for r in named)
