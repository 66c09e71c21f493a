"""Substring dedup by sliding sentence spans.

A text is cut into sentences (ends: . ! ? followed by white space, or a line break). From each sentence the shortest run
of at least `min_sentences` sentences and `min_words` words is a span (a single sentence of `lone_words` words also is
one). Spans are hashed and grouped over all documents; the first occurrence, by (document id, text hash, position),
stays, and sentences covered by any other occurrence are removed. Partial sentences at a passage's edges stay.

Edge cases: null or empty text has no sentences and stays as it is; rows with the same id and text count as one
occurrence and are treated alike, rows with the same id and different texts are told apart by their text (31 bits of its
hash); null ids come last, told apart by 62 bits of the text's hash, in the order of those; every occurrence after the
first within one document is removed, too; of occurrences with the same id and text, the first by position stays; an empty
table gives no rows; other columns pass through, whatever their names; a very long text is cut and joined sentence by
sentence, and its positions are counted in 31 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices

MIN_SENTENCES = 2
MIN_WORDS = 12
LONE_WORDS = 20
NO_ID = 2**63 - 1
_SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=\s)\s*|\n\s*|\Z)|\s+", re.S)


def sentences(text: str) -> list[str]:
    """The sentences in order with the white space after them; joined they are the text."""
    return [s for s in _SENTENCE.findall(text) if s]


def span_ends(n_words: list[int], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS, lone_words: int = LONE_WORDS) -> list[int]:
    """For each sentence the end (exclusive) of the span that begins there; 0 if none does."""
    sums = np.concatenate([[0], np.cumsum(n_words)])
    n = len(n_words)
    begin = np.arange(n)
    end = np.maximum(np.searchsorted(sums, sums[:-1] + min_words), begin + min_sentences)
    end = np.where((end > n) | (sums[np.minimum(end, n)] - sums[begin] < min_words), 0, end)
    return np.where(np.array(n_words) >= lone_words, begin + 1, end).tolist()


def spans(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(h, id, at, n): the hash of each span, its document, first sentence (with the text hash above it), sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as h

        for batch in slices(batches):
            hs, ids, ats, ns = [], [], [], []
            for doc, key, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words = [s.split() for s in sentences(text)]
                if not words:
                    continue
                digests = np.array([h(" ".join(w)) for w in words], np.uint64).tobytes()
                for i, end in enumerate(span_ends([len(w) for w in words])):
                    if end:
                        hs.append(h(digests[8 * i : 8 * end]))
                        ids.append(doc)
                        ats.append(key + i)
                        ns.append(end - i)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(hs, np.uint64).view(np.int64)), pa.array(ids, pa.int64()), pa.array(ats, pa.int64()), pa.array(ns, pa.int32())], ["h", "id", "at", "n"])

    rows = docs.where(F.col("text").isNotNull()).select(_id(id_col), _key(), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "h long, id long, at long, n int")


def _id(id_col: str):
    """Null ids take the last 2**31 numbers, by a hash of the text."""
    none = F.lit(NO_ID) - F.xxhash64(F.lit(1), F.col("text").cast("string")).bitwiseAND(F.lit(2**31 - 1))
    return F.coalesce(F.col(id_col).cast("long"), none).alias("id")


def _key():
    """31 bits of the text's hash, above 32 bits for a position."""
    return F.shiftleft(F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit(2**31 - 1)), 32).alias("at")


def repeated(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, key, cover): for each document with repeated spans, the [first, count] of each occurrence but the first."""
    found = spans(docs, id_col)
    first = found.groupBy("h").agg(F.min(F.struct("id", "at")).alias("first"), F.max(F.struct("id", "at")).alias("last")).where("first <> last").select("h", F.col("first.id").alias("fid"), F.col("first.at").alias("fat"))
    # Joined by another key than the aggregate's: both sides are dealt anew, so that adaptive execution can split the
    # many rows of one span; the aggregate's own partitions could not be split.
    other = F.col("h").bitwiseXOR(F.lit(1).cast("long")).alias("k")
    again = found.select(other, "id", "at", "n").join(first.select(other, "fid", "fat"), "k").where("id <> fid OR at <> fat")
    low = F.lit(2**32 - 1)
    return again.groupBy("id", (F.col("at") - F.col("at").bitwiseAND(low)).alias("key")).agg(F.collect_set(F.struct(F.col("at").bitwiseAND(low).cast("int").alias("i"), "n")).alias("cover"))


def _cut(docs: DataFrame, id_col: str) -> DataFrame:
    """(row, text, n_all, n_cut): the rows as structures, their text without repeats, sentences and removed sentences."""
    cover = repeated(docs, id_col).select(F.col("id").alias("c_id"), F.col("key").alias("c_key"), "cover")
    mine = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(mine, _id(id_col), _key(), F.col("text").cast("string").alias("text"))
    joined = marked.join(cover, (F.col("id") == F.col("c_id")) & (F.coalesce("at", F.lit(0)) == F.col("c_key")), "left")
    kinds = docs.select(mine).schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, n_all, n_cut = [], [], []
            for text, cover in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = sentences(text or "")
                gone = {j for c in cover or () for j in range(c["i"], c["i"] + c["n"])}
                texts.append("".join([s for j, s in enumerate(own) if j not in gone]) if gone else text)
                n_all.append(len(own))
                n_cut.append(len(gone))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n_all, pa.int32()), pa.array(n_cut, pa.int32())], ["row", "text", "n_all", "n_cut"])

    return map_arrow(joined.select("row", "text", "cover"), run, f"row {kinds}, text string, n_all int, n_cut int")


def _columns(docs: DataFrame) -> list:
    """The documents' own columns out of `_cut`, with the new text."""
    return [F.col("text").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows with text cut, all other columns as they came."""
    return _cut(docs, id_col).select(*_columns(docs))


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_sentences, n_removed, text): the query's form."""
    own = docs.select(F.col(id_col).alias(id_col), F.col("text").alias("text"))
    return _cut(own, id_col).select(F.col("row").getField(id_col).alias(id_col), F.col("n_all").alias("n_sentences"), F.col("n_cut").alias("n_removed"), "text")


def keep_unrepeated(docs: DataFrame) -> DataFrame:
    """Stage form: the documents' own columns; a document of which nothing but repeats is left goes."""
    cut = _cut(docs, "doc_id")
    return cut.where((F.col("n_cut") == 0) | (F.trim(F.col("text")) != "")).select(*_columns(docs))
