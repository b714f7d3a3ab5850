"""Language identification by prediction by partial matching (PPM).

A language's model is a variable-order byte context tree: for each context of
up to ``order`` bytes the counts of the bytes that followed it. A byte seen
after a context has the probability c / (n + d) there (n bytes followed the
context, d of them different); with d / (n + d) the model escapes to the next
shorter context, whose probabilities are shared out among the bytes not seen
in the longer one. Below the empty context all 257 symbols are equal. So each
context holds a whole distribution over bytes, and the code length of a text
is exactly the sum of -log2 p over its bytes. Statistics are frozen after
training.

Since nothing changes while texts are scored, the distributions are worked out
once: the context trees of all languages share one set of nodes, a table holds
the code length of every symbol at every node of a language's own tree, and an
index gives each language's row of it for every shared node (where a language
lacks the node, that of its longest known suffix). A task then walks ``order``
nodes per byte once for all languages, and adds a look-up for each.

Training uses a bounded sample: of each language the ``train_docs`` documents
with a text and the smallest hash (a hash bound per label, from their count, keeps the
candidates few at any size), up to ``train_bytes`` bytes of each, from a hashed place on. Counting keeps
contexts that a language saw at least ``min_count`` times, and its ``max_nodes``
most frequent ones at most. Neither other languages nor the size of their samples
take any from it. The tables have a size that does not grow with the input:
two of at most max_nodes x symbols x languages x 4 bytes.

The learned labels compete; the score is the probability of the best label
when all are equally likely before the text is read. A text that is null or
holds no letter is ``und`` with score 0, as is any text when no label could be
learned (no labelled text). Ties go to the label that comes first in code
point order. Repeated rows are scored one by one; a null id counts as not held
out, is not trained on, and is returned as null. An empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.llm.common import arrow_slices, column_of, releasing, whole_rows

ORDER = 4
TRAIN_DOCS = 256
TRAIN_BYTES = 32 << 10
MIN_COUNT = 6
MAX_NODES = 12_000
SLICE = 512 << 10
_PLAIN_LETTER = re.compile("[A-Za-z]")


@dataclass
class ContextTrees:
    """Frozen models of all labels over one set of nodes. ``symbol``: byte to
    symbol (bytes never trained on share one); ``child``: node x symbol to the
    node of the context one byte longer, or -1; ``rows``: label x node to the
    row of ``code`` that holds there; ``code``: row x symbol, bits."""

    labels: list[str]
    symbol: np.ndarray
    child: np.ndarray
    rows: np.ndarray
    code: np.ndarray
    order: int

    @property
    def cost(self) -> np.ndarray:
        """(node, symbol) x label, bits."""
        return self.code[self.rows].transpose(1, 2, 0).reshape(-1, len(self.labels))

    def bits(self, data: np.ndarray, offsets: np.ndarray, piece: int = 1 << 30) -> np.ndarray:
        """Code lengths (texts x labels) of texts laid end to end. Texts longer than
        ``piece`` bytes are scored in pieces, with the bytes before as contexts."""
        if len(data) <= piece:
            return self._bits(data, offsets)
        out = np.zeros((len(offsets) - 1, len(self.labels)))
        for i, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for at in range(low, high, piece):
                known = min(self.order, at - low)
                part = data[at - known:min(at + piece, high)]
                out[i] += self._bits(part, np.array([0, len(part)]), known)[0]
        return out

    def _bits(self, data: np.ndarray, offsets: np.ndarray, skip: int = 0) -> np.ndarray:
        """Without the first ``skip`` bytes, which are contexts only."""
        n, symbols = len(data), self.child.shape[1]
        x = self.symbol[data].astype(np.int32)
        start = np.zeros(n, np.int32)
        lengths = np.diff(offsets)
        filled = lengths > 0
        start[offsets[:-1][filled]] = 1
        position = np.arange(n, dtype=np.int64) - np.repeat(offsets[:-1], lengths)
        node = np.zeros(n, np.int32)
        going = np.ones(n, bool)
        flat = self.child.ravel()
        for back in range(1, self.order + 1):
            if n <= back:
                break
            going[:back] = False
            going &= position >= back
            at = np.flatnonzero(going)
            longer = flat[node[at].astype(np.int64) * symbols + x[at - back]]
            known = longer >= 0
            node[at[known]] = longer[known]
            going[at[~known]] = False
        out = np.zeros((len(lengths), len(self.labels)))
        if filled.any():
            code = self.code.ravel()
            for k, rows in enumerate(self.rows):
                cost = code[(rows.astype(np.int64) * symbols)[node] + x]
                cost[:skip] = 0
                out[filled, k] = np.add.reduceat(cost, offsets[:-1][filled], dtype=np.float64)
        return out


def count_contexts(samples: list[bytes], order: int) -> dict[bytes, dict[int, int]]:
    """Context (nearest byte first) to the counts of the bytes after it."""
    trees: dict[bytes, dict[int, int]] = {b"": {}}
    for length in range(order + 1):
        grams: dict[int, int] = {}
        for data in samples:
            a = np.frombuffer(data, np.uint8).astype(np.int64)
            if len(a) <= length:
                continue
            key = a[length:].copy()
            for back in range(1, length + 1):
                key += a[length - back:len(a) - back] << (8 * back)
            values, n = np.unique(key, return_counts=True)
            for v, c in zip(values.tolist(), n.tolist(), strict=True):
                grams[v] = grams.get(v, 0) + c
        for v, c in grams.items():
            context = bytes(v >> (8 * back) & 255 for back in range(1, length + 1))
            trees.setdefault(context, {})[v & 255] = c
    return trees


def fit(samples: dict[str, list[bytes]], order: int = ORDER, min_count: int = MIN_COUNT, max_nodes: int = MAX_NODES) -> ContextTrees:
    """Context trees of each label's samples."""
    labels = sorted(samples, key=lambda s: s.encode())
    counted = [count_contexts(samples[label], order) for label in labels]
    seen = sorted({b for tree in counted for b in tree[b""]})
    symbol = np.full(256, len(seen), np.uint8 if len(seen) < 256 else np.int16)
    symbol[seen] = np.arange(len(seen))
    width = len(seen) + 1
    own = []
    for tree in counted:
        weight = {context: sum(follow.values()) for context, follow in tree.items()}
        # a context's suffixes are at least as frequent, so this cut keeps them
        kept = sorted((c for c, n in weight.items() if n >= min_count or not c), key=lambda c: (-weight[c] if c else float("-inf"), len(c), c))[:max_nodes]
        own.append(sorted(kept, key=lambda c: (len(c), c)))
    chosen = sorted({c for kept in own for c in kept}, key=lambda c: (len(c), c))
    number = {c: i for i, c in enumerate(chosen)}
    parent = np.array([number[c[:-1]] for c in chosen])
    depth = np.array([len(c) for c in chosen])
    child = np.full((len(chosen), width), -1, np.int32)
    for context, i in number.items():
        if context:
            child[number[context[:-1]], symbol[context[-1]]] = i
    rows = np.full((len(labels), len(chosen)), -1, np.int32)
    tables, done = [], 0
    for k, (tree, kept) in enumerate(zip(counted, own, strict=True)):
        place = {c: i for i, c in enumerate(kept)}
        probability = np.empty((len(kept), width))
        for i, context in enumerate(kept):
            # the unseen symbol stands for all bytes without a symbol and the end
            shorter = probability[place[context[:-1]]] if context else np.append(np.full(width - 1, 1 / 257), (257 - width + 1) / 257)
            follow = tree[context]
            if not follow:
                probability[i] = shorter
                continue
            found = symbol[list(follow)]
            counts = np.fromiter(follow.values(), float, len(follow))
            total, kinds = counts.sum(), len(counts)
            p = shorter.copy()
            p[found] = 0
            rest = p.sum()
            p *= kinds / (total + kinds) / rest
            p[found] = counts / (total + kinds)
            probability[i] = p
        bits = -np.log2(probability)
        bits[:, -1] += np.log2(max(1, 257 - width + 1))
        tables.append(bits.astype(np.float32))
        rows[k, [number[c] for c in kept]] = np.arange(done, done + len(kept))
        done += len(kept)
        for n in range(1, order + 1):
            at = np.flatnonzero((depth == n) & (rows[k] < 0))
            rows[k, at] = rows[k, parent[at]]
    return ContextTrees(labels, symbol, child, rows, np.concatenate(tables), order)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, may_train: Column, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES) -> dict[str, list[bytes]]:
    """At most ``train_docs`` x ``train_bytes`` bytes per label, on the driver."""
    labelled = docs.where(may_train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0)).withColumn("lang", F.col("lang").cast("string"))
    # One number per label: hashes up to a bound that some 4 x train_docs
    # documents of the label keep, so the sort below sees few rows.
    bounds = {r["lang"]: (1 << 63) - 1 if r["n"] <= 4 * train_docs else -(1 << 63) + ((4 * train_docs) << 64) // r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not bounds:
        return {}
    bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
    # A longer text is learned from a slice anywhere in it.
    place = F.pmod(F.xxhash64("doc_id", F.lit("slice")), F.greatest(F.octet_length("text") - train_bytes, F.lit(0)) + 1) + 1
    rows = (labelled.withColumn("h", F.xxhash64("doc_id")).where(F.col("h") <= bound[F.col("lang")])
            .select("lang", "h", "doc_id", F.substring(F.encode("text", "UTF-8"), place.cast("int"), F.lit(train_bytes)).alias("data")))
    first = Window.partitionBy("lang").orderBy("h", "doc_id", "data")
    out: dict[str, list[bytes]] = {}
    for r in rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= train_docs).orderBy("lang", "r").collect():
        out.setdefault(r.lang, []).append(bytes(r.data))
    return out


def predict(docs: DataFrame, trees: ContextTrees | None, text: str, keep: str) -> DataFrame:
    """Column ``keep`` of ``docs`` with (lang, score, lettered) of its ``text`` column
    (or field)."""
    schema = docs.select(keep).schema.add("lang", "string").add("score", "double").add("lettered", "boolean")
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            for part in arrow_slices(batch, text, SLICE):
                values = pc.fill_null(column_of(part, text), "").cast(pa.large_string())
                offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
                held = values.buffers()[2]
                data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held and len(values) else np.empty(0, np.uint8)
                lettered = np.fromiter((bool(_PLAIN_LETTER.search(t)) or any(map(str.isalpha, t)) for t in values.to_pylist()), bool, len(values))
                if trees is None or not trees.labels:
                    label, score = ["und"] * len(values), np.zeros(len(values))
                else:
                    bits = trees.bits(data, offsets - offsets[0], SLICE)
                    best = bits.argmin(axis=1)
                    score = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                    label = [trees.labels[b] if k else "und" for b, k in zip(best, lettered, strict=True)]
                    score = np.where(lettered, score, 0.0)
                yield pa.RecordBatch.from_arrays([part.column(keep), pa.array(label, pa.string()), pa.array(score, pa.float64()), pa.array(lettered)], names=schema.names)

    return docs.mapInArrow(releasing(run), schema)


def trained(docs: DataFrame, order: int = ORDER, train_docs: int = TRAIN_DOCS, train_bytes: int = TRAIN_BYTES,
            min_count: int = MIN_COUNT, max_nodes: int = MAX_NODES) -> ContextTrees | None:
    """Models of the labelled documents that are not held out."""
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang"), F.col("text"))
    samples = training_sample(labelled, ~held_out(F.col("doc_id")), train_docs, train_bytes)
    return fit(samples, order, min_count, max_nodes) if samples else None


def identify(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), trained on the labelled documents
    that are not held out."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = predict(given, trained(docs, **settings), "text", "doc_id")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lang").alias("lang_pred"), "score")


def with_language(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents whose text is null or holds no letter; a null
    ``lang`` becomes the predicted one. What only lacks a learned label stays (and
    keeps its null)."""
    rows = predict(whole_rows(docs), trained(docs, **settings), "row.text", "row").where("lettered")
    row = F.col("row")
    if "lang" in docs.columns and docs.schema["lang"].dataType == StringType():
        row = row.withField("lang", F.coalesce("row.lang", F.nullif("lang", F.lit("und"))))
    return rows.select(row.alias("row")).select("row.*")
