"""Whole-text tokenization with a bounded cache of chunks.

A tokenizer that splits text before its merges gives the same ids for a text
as for its chunks one after another, if every cut lies where no token can
reach across. Natural text repeats its chunks, so a worker encodes a chunk
once and keeps its ids; the rest is an Arrow dictionary encoding and a numpy
gather. Which cuts are safe is read from the tokenizer's own file:

* ``spaced``: byte-level splitting with the built-in pattern. No pattern has a
  white-space character after another character, so a cut is safe between a
  character that is no white space and a following white space.
* ``words``: white space is normalised and dropped before merging, so a cut
  at each space is safe and the space itself has no ids.
* ``whole``: anything else; texts go to the tokenizer as they are.

Special strings inside texts hold no white space and are found within chunks
as they are in the text.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces kept per generation of the cache; two generations are alive at most.
CACHE_PIECES = 200_000
#: Codes expanded to ids at once.
EXPAND = 1 << 18

# White space in any of the libraries' senses; RE2 syntax for Arrow.
_WS = r"[\t-\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD_SPACES = f"{_WS} | {_WS}"
_RUN = re.compile(r"\s*\S+|\s+")
# Pieces of plain chunks: Latin letters, digits, ASCII signs but "'" (short
# forms) and "<" (special strings), and one line end between other pieces.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:;=-@\[-`{-~"
_PLAIN_SPACED = re.compile(rf" ?[{_LETTERS}0-9{_SIGNS}]+(?:\n[{_LETTERS}0-9{_SIGNS}]+)*")
_SPACED = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|\n")
_PLAIN_WORD = re.compile(rf"[{_LETTERS}0-9{_SIGNS}]+")
_WORD = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
# Byte-level alphabet: printable bytes stand for themselves, the others are
# numbered from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SELF)}


class TwoGenerations:
    """A mapping that forgets what was not used for a while: bounded memory."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file, special strings handled as
    the library does by default, no special tokens added."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre, norm, added = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec.get("added_tokens", ())
        plain = all("<" in t["content"] and not re.search(r"\s", t["content"]) and not t.get("lstrip") and not t.get("rstrip") for t in added)
        self.mode = "whole"
        if plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            self.mode = "spaced"
        elif plain and norm and [n["type"] for n in norm.get("normalizers", ())] == ["NFC", "Replace", "Lowercase"] and pre.get("type") == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["behavior"] == "Removed":
            self.mode = "words"
        self.model = self.tok.model
        self.cache = TwoGenerations(cache_pieces)

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each chunk."""
        cache, tokenize, words = self.cache, self.model.tokenize, self.mode == "words"
        plain, split = (_PLAIN_WORD.fullmatch, _WORD.findall) if words else (_PLAIN_SPACED.fullmatch, _SPACED.findall)
        out, rest = [], []
        for i, chunk in enumerate(chunks):
            ascii_only = chunk.isascii()
            if words:
                text = chunk.lower() if ascii_only else self.tok.normalizer.normalize_str(chunk)
            else:
                text = chunk
            if not plain(text):
                if not text:
                    out.append(b"")
                    continue
                rest.append(i)
                out.append(None)
                continue
            ids = []
            for piece in split(text):
                known = cache.new.get(piece)
                if known is None and (known := cache.get(piece)) is None:
                    mapped = piece.replace(" ", "Ġ").replace("\n", "Ċ") if ascii_only else piece.encode().decode("latin-1").translate(_BYTE_CHARS)
                    known = array("I", [t.id for t in tokenize(mapped)]).tobytes()
                    cache.put(piece, known)
                ids.append(known)
            out.append(ids[0] if len(ids) == 1 else b"".join(ids))
        if rest:
            for i, e in zip(rest, self.tok.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False), strict=True):
                out[i] = array("I", e.ids).tobytes()
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column without nulls, one after another, and
        the offsets of its rows (one more than rows)."""
        if pa.types.is_large_string(column.type):
            column = column.cast(pa.string())
        n = len(column)
        if self.mode == "whole":
            ids = [np.asarray(e.ids, "<u4") for e in self.tok.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
            return (np.concatenate(ids) if ids else np.empty(0, "<u4")), np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
        odd = np.empty(0, np.int64)
        if self.mode == "words":
            column = pc.replace_substring(pc.replace_substring(column, "\n", " "), "\t", " ")
        else:
            strange = pc.match_substring_regex(column, ODD_SPACES).to_numpy(zero_copy_only=False)
            if strange.any():
                odd = np.flatnonzero(strange)
                kept = column
                column = pc.if_else(pa.array(strange), "", column)
        lists = pc.split_pattern(column, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]) if n else lists.values
        offsets = offsets - (offsets[0] if n else 0)
        coded = words.dictionary_encode()
        codes, chunks = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.mode == "spaced":  # all but a text's first chunk begin with the space before them
            first = words.take(pa.array(offsets[:-1])).dictionary_encode()
            codes[offsets[:-1]] = len(chunks) + first.indices.to_numpy()
            chunks = [" " + c for c in chunks] + first.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(odd):
            runs = [_RUN.findall(kept[int(i)].as_py()) for i in odd]
            place: dict[str, int] = {}
            more = [[place.setdefault(c, len(place)) for c in run] for run in runs]
            per = np.diff(offsets)
            pieces, cut = [], 0
            for i, run in zip(odd, more, strict=True):
                pieces += [codes[cut:offsets[i]], np.asarray(run, np.int64) + len(chunks)]
                cut = offsets[i + 1]
                per[i] = len(run)
            codes = np.concatenate([*pieces, codes[cut:]])
            offsets = np.concatenate([[0], np.cumsum(per)])
            chunks = chunks + list(place)
        ids = self.chunk_ids(chunks)
        lengths = np.fromiter((len(x) >> 2 for x in ids), np.int64, len(ids))
        known = np.frombuffer(b"".join(ids), "<u4")
        starts = np.cumsum(lengths) - lengths
        ends = np.concatenate([[0], np.cumsum(lengths[codes])])
        flat = np.empty(ends[-1], "<u4")
        for i in range(0, len(codes), EXPAND):
            part = codes[i:i + EXPAND]
            per, low, high = lengths[part], ends[i], ends[min(i + EXPAND, len(codes))]
            flat[low:high] = known[np.arange(high - low) + np.repeat(starts[part] - (ends[i:i + len(part)] - low), per)]
        return flat, ends[offsets]


_LOADED: dict = {}


def loaded(path: str) -> Encoder:
    """The worker's encoder of that file: one for all its tasks."""
    if path not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
