"""Token counts with a cache of digests.

The cache is a Parquet table (digest, tokenizer, n_tokens) in a shared folder:
``digest`` is the SHA-256 of the normalised content (null as empty; nothing
else is changed, since the count depends on every character) and ``tokenizer``
the SHA-256 of the tokenizer's file, so that another version never meets old
counts. Counting joins the documents' digests to the cache, encodes only the
distinct contents that it lacks, appends their counts, and joins again.

One copy of each missing content is encoded: the smallest row key stands for
its digest (of rows that repeat both key and text, one per slice of a task). A digest that a third of all rows share is one key of a join
between rows and digests only; it never gathers texts.

Null texts count as empty (0 tokens). Repeated rows are counted once each and
give one output row each. An empty table gives an empty result and appends
nothing. Null ids stay null. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, arrow_slices, texts
from quarry.llm.encode import ODD_SPACES

SLICE = 8 << 20
_ODD = rf"^ | $|  |▁|\p{{Cf}}|[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{{84}}\x{{86}}-\x{{9f}}]|{ODD_SPACES}"
_PIECES: dict = {}


class PieceCounter:
    """Token counts of whole texts by a ``sentencepiece`` model.

    The model turns each space into a mark and puts one before the text. If no
    piece has the mark after another character, no token reaches across a
    space that follows another character, and a text's count is the sum of its
    words' counts; each distinct word of a slice is encoded once. Texts with a
    space at an end or next to other white space, with a mark of their own or with
    control or format characters (which normalisation may drop), and models with
    other rules, go to the model whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = "▁"
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        probe = ["a b", "x  y", "Aé́ ﬁ"]
        keeps = [self.model.decode(self.model.encode(p, add_bos=False, add_eos=False)) for p in probe] == probe
        self.by_word = keeps and all(mark not in p.lstrip(mark) for p in pieces) and self.model.encode("a", out_type=str)[0].startswith(mark)

    def lengths(self, values: list[str]) -> np.ndarray:
        return np.fromiter(map(len, self.model.encode(values, num_threads=1, add_bos=False, add_eos=False)), np.int64, len(values))

    def count(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        if not self.by_word or not n:
            return self.lengths(column.to_pylist())
        column = column.cast(pa.string())
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", column), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets -= offsets[0]
        each = self.lengths(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
        out = np.diff(ends[offsets])
        at = np.flatnonzero(odd)
        out[at] = self.lengths([column[int(i)].as_py() for i in at])
        return out


def _counter(path: str) -> PieceCounter:
    if path not in _PIECES:
        _PIECES[path] = PieceCounter(path)
    return _PIECES[path]


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def token_counts(docs: DataFrame, model: str, cache: str, scratch: Scratch, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit); new counts are appended to the
    Parquet table at ``cache``, which is made if it is missing."""
    spark, version = docs.sparkSession, tokenizer_digest(model)
    rows = texts(docs).withColumn("digest", F.sha2(F.encode("text", "UTF-8"), 256))
    stored = spark.createDataFrame([], "digest string, tokenizer string, n_tokens long")
    stored.write.mode("append").parquet(cache)
    read = lambda: spark.read.schema("digest string, tokenizer string, n_tokens long").parquet(cache).where(F.col("tokenizer") == version)
    digests = scratch.write(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    missing = (digests.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
               .join(read().select("digest"), "digest", "left_anti"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            for part in arrow_slices(batch, "text", SLICE):
                first = {d: i for i, d in reversed(list(enumerate(part.column("digest").to_pylist())))}
                part = part.take(pa.array(sorted(first.values())))
                n = pa.array(counter.count(part.column("text")), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array([version] * part.num_rows), n], names=["digest", "tokenizer", "n_tokens"])

    # The rows that stand for a digest are found by key; their texts are the
    # probe side of a hash join, so texts are not sorted.
    texts_of = rows.join(missing.select("digest", F.col("doc_id").alias("_first")).hint("shuffle_hash"),
                         "digest").where(F.col("doc_id").eqNullSafe(F.col("_first"))).select("digest", "text")
    fresh = texts_of.mapInArrow(encode, "digest string, tokenizer string, n_tokens long")
    fresh.dropDuplicates(["digest"]).write.mode("append").parquet(cache)
    # Written first: a join with a plain table, unlike one with an aggregation
    # on the same key, is split where a digest is very common.
    counts = scratch.write(read().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return (digests.join(counts, "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
