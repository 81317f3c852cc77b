"""Removal of passages of many words that an earlier document has too.

A passage is a window of `size` words. Anchors thin the windows out first: of
every `size - gram + 1` neighbouring word runs of `gram` words those with the
smallest hash, so that equal windows hold equal anchors. Pass one counts the
anchors in a count-min sketch. Pass two keeps the windows whose own anchor is
estimated to occur twice, and only those are grouped, by two hashes of 64 bits
each, with the smallest doc_id of each group. A window is removed from every
document with a larger doc_id.

Before the shuffle each batch settles its own repetitions: only the occurrence
with the smallest doc_id goes on, the others are known to be removed, so a
passage that a third of all documents share sends one row a batch.

Defined results: null, empty and wordless texts have no words and lose none; a
document with a null doc_id keeps all its words and removes none; repeated rows
have equal doc_ids and so don't remove each other's words; rows that share a
doc_id but not the text are cut each by its own windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.llm import sketch
from tempora.llm.textkit import SPACE_WORDS, U64, WORD_BASE, WORD_BASE_2, Words, binary, blocks, mix, read_table, sliding, window_hash, winnow


def _grams(words: Words, hashes: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the word runs of documents that hold a window."""
    at = words.windows(gram)
    if not len(at):
        return at, np.zeros(0, U64)
    long = np.repeat(words.counts >= size, words.counts)
    at = at[long[at]]
    return at, window_hash(hashes, at, gram)


def _repeated_windows(words: Words, hashes: np.ndarray, size: int, gram: int, sets: np.ndarray, bits: int) -> np.ndarray:
    """First words of the windows whose anchor, their own smallest hash, is estimated repeated."""
    at, keys = _grams(words, hashes, size, gram)
    span = size - gram + 1
    if len(at) < span:
        return np.zeros(0, np.int64)
    lowest = sliding(keys, span, np.minimum, np.iinfo(U64).max)
    whole = at[span - 1 :] - at[: len(lowest)] == span - 1
    fresh = np.concatenate(([True], lowest[1:] != lowest[:-1]))
    flags = sketch.estimated_repeated(lowest[fresh], sets, bits)[np.cumsum(fresh) - 1]
    return at[: len(lowest)][whole & flags]


def _runs(document: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last indices of stretches of consecutive places of one document."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (document[1:] != document[:-1])
    first = np.flatnonzero(fresh)
    return first, np.append(first[1:], len(at)) - 1


def repeated_windows(docs: DataFrame, size: int = 50, gram: int = 25, bits: int = sketch.BITS) -> DataFrame:
    """doc_id, tag, and spans of words to remove; tag tells texts of one doc_id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag")).where("doc_id is not null and text is not null")

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        data, offsets = binary(batch.column(1))
        for a, b in blocks(offsets):
            words = Words(data, offsets[a : b + 1], SPACE_WORDS)
            grams = _grams(words, words.hashes(), size, gram)[1]
            yield grams[winnow(grams, size - gram + 1)]

    shared = sketch.repeated(rows, keys, bits)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary(batch.column(1))
            ids = batch.column(0).to_numpy()
            tags = batch.column(2).to_numpy()
            found = []
            for a, b in blocks(offsets):
                words = Words(data, offsets[a : b + 1], SPACE_WORDS)
                hashes = words.hashes()
                windows = _repeated_windows(words, hashes, size, gram, shared.value, bits)
                document = np.searchsorted(words.first, windows, "right") - 1
                found.append((window_hash(hashes, windows, size), window_hash(hashes, windows, size, WORD_BASE_2), document + a, windows - words.first[document]))
            if found:
                yield _settled(*(np.concatenate(x) for x in zip(*found, strict=True)), ids, tags)

    windows = rows.mapInArrow(candidates, "h1 long, h2 long, doc_id long, tag long, first int, last int, known boolean")
    group = Window.partitionBy("h1", "h2").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    removed = windows.withColumn("earliest", F.first("doc_id").over(group)).where(F.col("known") | (F.col("earliest") < F.col("doc_id")))
    return removed.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _settled(h1: np.ndarray, h2: np.ndarray, document: np.ndarray, at: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> pa.RecordBatch:
    """One row for the earliest occurrence in the batch; stretches for what comes after it."""
    order = np.lexsort((at, document, ids[document], h2, h1))
    a, b, own = h1[order], h2[order], ids[document[order]]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(fresh) - 1
    lowest = own[fresh][group]
    open_rows = order[own == lowest]
    later = np.sort(order[own != lowest])
    first, last = _runs(document[later], at[later])
    d = document[later][first]
    salt = mix(later[first].astype(U64) + ids[d].astype(U64) * U64(0x9E3779B97F4A7C15))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate((h1[open_rows], salt)).view(np.int64)),
            pa.array(np.concatenate((h2[open_rows], salt)).view(np.int64)),
            pa.array(np.concatenate((ids[document[open_rows]], ids[d]))),
            pa.array(np.concatenate((tags[document[open_rows]], tags[d]))),
            pa.array(np.concatenate((at[open_rows], at[later][first])).astype(np.int32)),
            pa.array(np.concatenate((at[open_rows], at[later][last])).astype(np.int32)),
            pa.array(np.concatenate((np.zeros(len(open_rows), bool), np.ones(len(first), bool)))),
        ],
        names=["h1", "h2", "doc_id", "tag", "first", "last", "known"],
    )


def deduplicate(docs: DataFrame, size: int = 50, gram: int = 25, bits: int = sketch.BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text of every document.

    kept_text: the words that stay, joined by one space.
    """
    spans = repeated_windows(docs, size, gram, bits)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if spans.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    flat = spans.values
                    np.add.at(edge, flat.field(0).to_numpy(), 1)
                    np.add.at(edge, flat.field(1).to_numpy() + size, -1)
                    stay = np.cumsum(edge)[:-1] == 0
                    words = [words[i] for i in np.flatnonzero(stay)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            columns = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = rows.join(spans.hint("shuffle_hash"), ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents")).drop("kept_text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op7_substrings": op7_substrings}
