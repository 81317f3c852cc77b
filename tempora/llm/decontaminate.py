"""Benchmark decontamination with an FM-index over each shard of training text.

A task reads its documents in shards of a few MB. Words become symbols: a word
that some test phrase holds gets its own symbol, all others share one, and runs
of phrase words shorter than the shortest phrase are left out of the indexed
sequence, since no phrase can occur there. The shard's suffix array gives the
Burrows-Wheeler transform, kept in a wavelet tree with sampled ranks. All test
phrases are then searched backwards at once, and the places of their
occurrences come from suffix positions sampled every few symbols and walks
along the last-to-first mapping. Overlapping occurrences merge into the spans
to remove.

Nothing is shuffled unless the benchmark is larger than one block of phrases:
each block is a pass over the documents, and their spans then meet by a number of
the row.

Defined results: null, empty and wordless texts have no words, no hits and are
not contaminated; null and wordless benchmark items have no windows; benchmark
rows of one item_id are one item with the windows of all; rows without an item_id
are none; a null doc_id stays null; equal rows give equal result rows; an empty benchmark hits
nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.suffixes import suffix_array
from tempora.llm.textkit import ALNUM_WORDS, Words, binary, blocks, id_and_text, lean, materialise, read_table, window_hash

SPAN = "struct<first:long,last:long>"
#: UTF-8 bytes of benchmark text in one block of phrases, which is broadcast.
BLOCK_TEXT = 32 << 20
#: UTF-8 bytes of documents under one FM-index.
SHARD_BYTES = 4 << 20


class BitRanks:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        words = np.zeros(n // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Symbols by place and ranks of symbols, one bit vector a level.

    The nodes of a level lie side by side, zeros first, in the order of the
    bits read so far.
    """

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.depth = max(1, int(kinds - 1).bit_length())
        self.levels, now = [], symbols
        for level in range(self.depth):
            bits = (now >> (self.depth - 1 - level)) & 1
            ranks = BitRanks(bits.astype(bool))
            self.levels.append((ranks, len(now) - ranks.ones))
            now = np.concatenate((now[bits == 0], now[bits == 1]))
        #: where each symbol's block begins below the last level
        self.begin = np.searchsorted(now, np.arange(kinds)) if self._sorted(now) else self._trace(np.arange(kinds))

    @staticmethod
    def _sorted(now: np.ndarray) -> bool:
        return bool((now[1:] >= now[:-1]).all())

    def _trace(self, symbols: np.ndarray) -> np.ndarray:
        return self._down(symbols, np.zeros(len(symbols), np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ranks, zeros) in enumerate(self.levels):
            ones = ranks.rank(at)
            at = np.where((symbols >> (self.depth - 1 - level)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbols[i] stands before place at[i]."""
        return self._down(symbols, at) - self.begin[symbols]

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at those places and their ranks there."""
        symbols = np.zeros(len(at), np.int64)
        for ranks, zeros in self.levels:
            bit, ones = ranks.get(at).astype(np.int64), ranks.rank(at)
            at = np.where(bit == 1, zeros + ones, at - ones)
            symbols = symbols << 1 | bit
        return symbols, at - self.begin[symbols]


class FMIndex:
    """Counts and locates sequences of symbols in a text of symbols from 1."""

    def __init__(self, text: np.ndarray, kinds: int, every: int = 8):
        text = np.append(text, 0)  # the only 0 ends the text
        order = suffix_array(text)
        self.tree = WaveletTree(text[order - 1].astype(np.int64), kinds)
        self.less = np.zeros(kinds + 1, np.int64)
        np.cumsum(np.bincount(text, minlength=kinds), out=self.less[1:])
        kept = order % every == 0
        self.marked, self.sampled = BitRanks(kept), order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of symbols: the ranges of the suffixes that begin with them."""
        low = self.less[phrases[:, -1]]
        high = self.less[phrases[:, -1] + 1]
        alive = np.flatnonzero(low < high)
        for place in range(phrases.shape[1] - 2, -1, -1):
            symbols = phrases[alive, place]
            low[alive] = self.less[symbols] + self.tree.rank(symbols, low[alive])
            high[alive] = self.less[symbols] + self.tree.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to a sampled one."""
        found = np.zeros(len(rows), np.int64)
        left, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(left):
            here = self.marked.get(rows).astype(bool)
            found[left[here]] = self.sampled[self.marked.rank(rows[here])] + steps
            left, rows = left[~here], rows[~here]
            symbols, ranks = self.tree.get(rows)
            rows = self.less[symbols] + ranks
            steps += 1
        return found


class Phrases:
    """The windows of a block of benchmark items, as rows of symbols by length."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        # an item_id that stands in several rows is one item
        self.names = list(dict.fromkeys(i for i, _ in items))
        number = {name: at for at, name in enumerate(self.names)}
        data, offsets = binary(texts)
        words = Words(data, offsets, ALNUM_WORDS, lower=True)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)  # symbol = place + 2; 1 is any other word
        symbols = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 2
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for item, n in enumerate(words.counts):
            if n:
                own = symbols[words.first[item] : words.first[item + 1]]
                k = min(size, int(n))
                view = np.lib.stride_tricks.sliding_window_view(own, k)
                rows.setdefault(k, []).append(view)
                owners.setdefault(k, []).append(np.full(len(view), number[items[item][0]]))
        self.groups = []
        for k in rows:
            table, back = np.unique(np.concatenate(rows[k]), axis=0, return_inverse=True)
            owner = np.concatenate(owners[k])
            order = np.lexsort((owner, back.ravel()))
            first = np.searchsorted(back.ravel()[order], np.arange(len(table) + 1))
            self.groups.append((k, table, owner[order], first))
        self.shortest = min(rows, default=0)
        self.kinds = len(self.vocabulary) + 2


class Shard:
    """Symbols of the stretches of one shard in which a phrase can lie."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.parts, self.places = phrases, [], []

    def add(self, words: Words, hashes: np.ndarray, base: int) -> None:
        """base: the number of the block's first word in the shard."""
        vocabulary = self.phrases.vocabulary
        at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        known = vocabulary[at] == hashes
        document = np.repeat(np.arange(len(words.counts)), words.counts)
        joined = known[1:] & known[:-1] & (document[1:] == document[:-1])
        begin = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        end = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        long = end - begin >= self.phrases.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        sizes = end - begin + 1  # and a break
        total = int(sizes.sum())
        start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        place = np.arange(total) - np.repeat(start - begin, sizes)
        stop = start + sizes - 1
        symbols = np.ones(total, np.int64)
        inside = np.ones(total, bool)
        inside[stop] = False
        symbols[inside] = at[place[inside]] + 2
        self.parts.append(symbols)
        self.places.append(place + base)

    def hits(self) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Word numbers where phrases begin, phrase length, and item numbers."""
        if not self.parts:
            return
        place = np.concatenate(self.places)
        index = FMIndex(np.concatenate(self.parts), self.phrases.kinds)
        for k, table, owner, first in self.phrases.groups:
            low, high = index.search(table)
            found = np.flatnonzero(high > low)
            if not len(found):
                continue
            counts = high[found] - low[found]
            which = np.repeat(found, counts)
            rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - low[found], counts)
            at = place[index.locate(rows)]
            owners = first[which + 1] - first[which]
            flat = np.arange(owners.sum()) - np.repeat(np.cumsum(owners) - owners - first[which], owners)
            yield np.repeat(at, owners), k, owner[flat]


def find_hits(docs: DataFrame, items: list[tuple[str, str]], size: int = 13, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, spans of hit words (disjoint, sorted), ids of the items found.

    items: one block of (item id, text); it travels with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast((items, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(*shared.value)
        for batch in batches:
            data, offsets = binary(batch.column(1))
            for a, b in blocks(offsets, shard_bytes):
                yield _shard_result(phrases, batch.column(0).slice(a, b - a), data, offsets[a : b + 1])

    return id_and_text(docs).mapInArrow(lean(run), f"doc_id long, n_words long, spans array<{SPAN}>, items array<string>")


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _shard_result(phrases: Phrases, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    shard, counts = Shard(phrases), []
    base = 0
    for a, b in blocks(offsets):
        words = Words(data, offsets[a : b + 1], ALNUM_WORDS, lower=True)
        if phrases.groups and len(words.starts):
            shard.add(words, words.hashes(), base)
        counts.append(words.counts)
        base += len(words.starts)
    counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(counts)))
    edge = np.zeros(base + 1, np.int64)
    pairs = []
    for at, k, item in shard.hits():
        np.add.at(edge, at, 1)
        np.add.at(edge, at + k, -1)
        pairs.append(np.unique(np.stack((np.searchsorted(first, at, "right") - 1, item)), axis=1))
    hit = np.cumsum(edge)[:-1] > 0
    document = np.repeat(np.arange(len(counts)), counts)
    joined = np.zeros(len(hit), bool)
    if base:
        joined[1:] = hit[1:] & hit[:-1] & (document[1:] == document[:-1])
    begin = np.flatnonzero(hit & ~joined)
    last = np.zeros(len(hit), bool)
    if base:
        last[:-1] = hit[:-1] & ~joined[1:]
        last[-1] = hit[-1]
    end = np.flatnonzero(last) + 1
    owner = document[begin] if base else begin
    sizes = np.bincount(owner, minlength=len(counts))
    spans = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), pa.StructArray.from_arrays([pa.array(begin - first[owner]), pa.array(end - first[owner])], ["first", "last"]))
    if pairs:
        pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
    else:
        pairs = np.zeros((2, 0), np.int64)
    names = pa.array(phrases.names, pa.string()).take(pa.array(pairs[1]))
    sizes = np.bincount(pairs[0], minlength=len(counts))
    items = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), names)
    return pa.RecordBatch.from_arrays([ids, pa.array(counts), spans.cast(_RESULT.field(2).type), items], schema=_RESULT)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted spans that cover the same words."""
    merged: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], last))
        else:
            merged.append((first, last))
    return merged


def _merge_passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [[{"first": a, "last": b} for a, b in merge_spans([(s["first"], s["last"]) for s in row])] for row in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _RESULT.field(2).type), batch.column(3)], names=["row", *_RESULT.names[1:]])


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, block_text: int = BLOCK_TEXT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Hit words and items of every document; docs: doc_id, text; benchmark: item_id, text.

    A benchmark of up to `block_text` bytes is one pass over the documents
    without a shuffle; a larger one is cut by item_id into as many passes as it
    has blocks, joined by document.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")
    total = items.agg(F.sum(F.octet_length("text") + F.octet_length("item_id"))).first()[0] or 0
    passes = max(1, math.ceil(total / block_text))
    if passes == 1:
        return find_hits(docs, [tuple(r) for r in items.collect()], size, shard_bytes)
    # rows of one doc_id, or of none, are told apart by a number that is written with them
    rows = materialise(id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    found = None
    for n in range(passes):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == n)
        hits = find_hits(rows.select(F.col("row").alias("doc_id"), "text"), [tuple(r) for r in block.collect()], size, shard_bytes)
        found = hits if found is None else found.unionByName(hits)
    # every item is in one block
    numbered = found.groupBy("doc_id").agg(F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    merged = numbered.mapInArrow(lean(_merge_passes), f"row long, n_words long, spans array<{SPAN}>, items array<string>")
    return rows.select("row", "doc_id").join(merged, "row").drop("row")


def judged(found: DataFrame) -> DataFrame:
    """The digest columns of the contract."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return (
        found.withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op8_decontaminate": op8_decontaminate}
