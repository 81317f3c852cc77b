"""Removal of byte strings that occur earlier, by suffix arrays of bounded shards.

Only text that can repeat is sorted. Of every stretch of neighbouring byte runs
of half a string's length those with the smallest hash are its anchors; a
count-min sketch over all texts tells which anchors can occur twice. The strings
whose anchor can, with the text around the anchor, form contexts, and contexts
meet by anchor: equal strings have the same anchor, so they meet too. A batch
keeps only the earliest of equal contexts before the shuffle; the others are
already known to repeat.

A task sorts its contexts by anchor, document and place and cuts them into
shards. Each shard gets a suffix array by Larsson-Sadakane refinement and common
prefixes by Kasai's rule; suffixes that share a whole string form a group, and
all but the earliest member are marked. Where one anchor has more text than a
shard, the strings of its later shards are searched by bisection in the sorted
strings of the earlier ones, which merges the shards.

Defined results: null counts as empty and loses nothing; a document with a null
doc_id keeps all its bytes and removes none; repeated rows (equal doc_id and
text) are judged as one document; rows that share a doc_id but not the text are
documents of which neither is earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm import sketch
from tempora.llm.suffixes import common_prefixes, suffix_array
from tempora.llm.textkit import BYTE_BASE, U64, WORD_BASE, WORD_BASE_2, binary, blocks, mix, range_hash, read_table, sliding, winnow

#: Bytes of contexts in one shard; an anchor with more is cut into several.
SHARD_BYTES = 1 << 20


def _grams(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the runs of size // 2 bytes of documents that hold a string."""
    gram, lengths = size // 2, np.diff(offsets)
    left = np.repeat(offsets[1:], lengths) - np.arange(len(data))
    at = np.flatnonzero((left >= gram) & np.repeat(lengths >= size, lengths))
    return at, range_hash(data.astype(U64) + U64(1), at, at + gram, BYTE_BASE)


class Contexts:
    """Stretches of strings that share an anchor which can occur twice."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, size: int, sets: np.ndarray, bits: int):
        at, keys = _grams(data, offsets, size)
        span = size - size // 2 + 1
        self.first = self.last = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, U64)
        if len(at) < span:
            return
        lowest = sliding(keys, span, np.minimum, np.iinfo(U64).max)
        begin = at[: len(lowest)]
        whole = at[span - 1 :] - begin == span - 1
        fresh = np.concatenate(([True], lowest[1:] != lowest[:-1]))
        keep = whole & sketch.estimated_repeated(lowest[fresh], sets, bits)[np.cumsum(fresh) - 1]
        begin, lowest = begin[keep], lowest[keep]
        if not len(begin):
            return
        fresh = np.concatenate(([True], (lowest[1:] != lowest[:-1]) | (begin[1:] != begin[:-1] + 1)))
        edges = np.flatnonzero(fresh)
        self.first, self.anchor = begin[edges], lowest[edges]
        self.last = begin[np.append(edges[1:], len(begin)) - 1]


def _gather(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte strings data[first:end] as an Arrow array."""
    sizes = end - first
    stops = np.concatenate(([0], np.cumsum(sizes)))
    flat = data[np.arange(stops[-1]) - np.repeat(stops[:-1] - first, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(stops.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


_FOUND = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("context", pa.binary())])


def _settled(parts: list[tuple], ids: np.ndarray, tags: np.ndarray) -> pa.RecordBatch:
    """The earliest of equal contexts with its bytes; the others without, since all their strings go."""
    document, first, last, anchor, h1, h2 = (np.concatenate(x) for x in zip(*(p[:6] for p in parts), strict=True))
    contexts = pa.chunked_array([p[6] for p in parts]).combine_chunks()
    order = np.lexsort((first, tags[document], ids[document], h2, h1))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    group = np.cumsum(fresh) - 1
    own, tag, at = ids[document[order]], tags[document[order]], first[order]
    part = fresh.copy()
    part[1:] |= (own[1:] != own[:-1]) | (tag[1:] != tag[:-1])
    start = at[part][np.cumsum(part) - 1]
    known = np.zeros(len(order), bool)
    known[order] = (own != own[fresh][group]) | (at > start)
    anchor = np.where(known, mix(first.astype(U64) + ids[document].astype(U64) * U64(BYTE_BASE)), anchor)
    empty = pa.array(known)
    contexts = pa.compute.if_else(empty, pa.scalar(None, pa.binary()), contexts)
    columns = [pa.array(anchor.view(np.int64)), pa.array(ids[document]), pa.array(tags[document]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), contexts]
    return pa.RecordBatch.from_arrays(columns, schema=_FOUND)


class Shard:
    """Contexts in the order of anchor, document and place."""

    def __init__(self, anchor: np.ndarray, doc: np.ndarray, tag: np.ndarray, first: np.ndarray, data: np.ndarray, sizes: np.ndarray):
        """data: the contexts' bytes, one after the other."""
        self.anchor, self.doc, self.tag, self.first, self.data, self.sizes = anchor, doc, tag, first, data, sizes
        # contexts stand apart by a symbol of their own
        self.begin = np.cumsum(sizes) - sizes + np.arange(len(sizes))
        self.text = np.full(int(sizes.sum()) + len(sizes), 256, np.int64)
        inside = np.ones(len(self.text), bool)
        inside[self.begin + sizes] = False
        self.text[inside] = data

    @classmethod
    def of(cls, rows: pa.Table) -> Shard:
        rows = rows.combine_chunks()
        data, offsets = binary(rows.column("context"))
        return cls(*(rows.column(c).to_numpy() for c in ("anchor", "doc_id", "tag", "first")), data[offsets[0] : offsets[-1]], np.diff(offsets))

    def part(self, rows: np.ndarray) -> Shard:
        begin = (np.cumsum(self.sizes) - self.sizes)[rows]
        sizes = self.sizes[rows]
        stops = np.cumsum(sizes)
        data = self.data[np.arange(sizes.sum()) - np.repeat(stops - sizes - begin, sizes)]
        return Shard(self.anchor[rows], self.doc[rows], self.tag[rows], self.first[rows], data, sizes)

    def repeats(self, size: int) -> np.ndarray:
        """A flag by text place: a string that an earlier place has begins here.

        Equal contexts are settled first, and a context without any other of its
        anchor, in which the anchor stands once, can't repeat; the suffixes of
        all others are sorted.
        """
        flags = np.zeros(len(self.text), bool)
        wide, ends = self.data.astype(U64) + U64(1), np.cumsum(self.sizes)
        begins = ends - self.sizes
        h1, h2 = range_hash(wide, begins, ends, WORD_BASE), range_hash(wide, begins, ends, WORD_BASE_2)
        order = np.lexsort((np.arange(len(h1)), h2, h1, self.anchor))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]) | (self.anchor[order][1:] != self.anchor[order][:-1])
        earliest = np.empty(len(order), np.int64)
        earliest[order] = order[fresh][np.cumsum(fresh) - 1]
        again = earliest != np.arange(len(order))
        known = again & ((self.doc > self.doc[earliest]) | (self.tag == self.tag[earliest]) & (self.first > self.first[earliest]))
        flags[self.spread(np.flatnonzero(known), size)] = True

        gram = size // 2
        counts = self.sizes - gram + 1
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - begins, counts)
        found = range_hash(wide, at, at + gram, BYTE_BASE).view(np.int64) == np.repeat(self.anchor, counts)
        times = np.add.reduceat(found.astype(np.int64), np.cumsum(counts) - counts)
        rest = np.flatnonzero(~known)
        _, which, members = np.unique(self.anchor[rest], return_inverse=True, return_counts=True)
        rest = rest[(members[which] > 1) | (times[rest] > 1)]
        if len(rest):
            part = self.part(rest)
            marked = part.sorted_repeats(size)
            places = np.flatnonzero(marked)
            row = np.searchsorted(part.begin, places, "right") - 1
            flags[self.begin[rest[row]] + places - part.begin[row]] = True
        return flags

    def spread(self, rows: np.ndarray, size: int) -> np.ndarray:
        """Begins of the strings of those contexts."""
        counts = self.sizes[rows] - size + 1
        return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - self.begin[rows], counts)

    def sorted_repeats(self, size: int) -> np.ndarray:
        """The same flags, by the suffix array of the whole shard."""
        order = suffix_array(self.text)
        alike = common_prefixes(self.text, order, size) >= size
        group = np.cumsum(~alike)
        valid = np.zeros(len(self.text), bool)
        valid[self.spread(np.arange(len(self.sizes)), size)] = True
        paired = alike.copy()
        paired[:-1] |= alike[1:]
        keep = valid[order] & paired
        places, group = order[keep], group[keep]
        row = np.searchsorted(self.begin, places, "right") - 1
        again = np.lexsort((places, group))
        places, group, row = places[again], group[again], row[again]
        doc, tag, at = self.doc[row], self.tag[row], self.first[row] + places - self.begin[row]
        flags = np.zeros(len(self.text), bool)
        if not len(places):
            return flags
        # places follow the order of documents, so a group's first member is the earliest
        fresh = np.concatenate(([True], group[1:] != group[:-1]))
        part = fresh | np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])))
        start = at[part][np.cumsum(part) - 1]
        flags[places] = (doc != doc[fresh][np.cumsum(fresh) - 1]) | (at > start)
        return flags

    def strings(self, places: np.ndarray, size: int) -> np.ndarray:
        text = self.text.astype(np.uint8)
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, size)[places]).view(f"S{size}").ravel()


class Merged:
    """Sorted strings of the earlier shards of one anchor."""

    def __init__(self) -> None:
        self.anchor: int | None = None
        self.tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def search(self, shard: Shard, flags: np.ndarray, size: int) -> None:
        """Marks strings of the anchor that earlier shards hold."""
        rows = np.flatnonzero(shard.anchor == self.anchor)
        places = shard.spread(rows, size)
        if not len(places):
            return
        strings = shard.strings(places, size)
        row = np.searchsorted(shard.begin, places, "right") - 1
        for table, doc, tag in self.tables:
            at = np.minimum(np.searchsorted(table, strings), len(table) - 1)
            found = table[at] == strings
            flags[places] |= found & ((shard.doc[row] > doc[at]) | ((shard.doc[row] == doc[at]) & (shard.tag[row] == tag[at])))

    def keep(self, shard: Shard, anchor: int, flags: np.ndarray, size: int) -> None:
        """Remembers the strings of the anchor that are new in this shard."""
        if anchor != self.anchor:
            self.anchor, self.tables = anchor, []
        places = shard.spread(np.flatnonzero(shard.anchor == anchor), size)
        places = places[~flags[places]]
        if len(places):
            strings = shard.strings(places, size)
            row = np.searchsorted(shard.begin, places, "right") - 1
            order = np.argsort(strings, kind="stable")
            self.tables.append((strings[order], shard.doc[row][order], shard.tag[row][order]))


def _spans(shard: Shard, flags: np.ndarray) -> pa.RecordBatch:
    """Stretches of marked strings: doc_id, tag, first and last begin."""
    places = np.flatnonzero(flags)
    fresh = np.ones(len(places), bool)
    fresh[1:] = places[1:] != places[:-1] + 1
    edges = np.flatnonzero(fresh)
    stops = np.append(edges[1:], len(places))[: len(edges)] - 1
    row = np.searchsorted(shard.begin, places[edges], "right") - 1
    move = shard.first[row] - shard.begin[row]
    columns = [shard.doc[row], shard.tag[row], (places[edges] + move).astype(np.int32), (places[stops] + move).astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "tag", "first", "last"])


def repeated_strings(docs: DataFrame, size: int = 100, bits: int = sketch.BITS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, tag and the stretches of begins of strings to remove."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag")).where("doc_id is not null and text is not null")

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        data, offsets = binary(batch.column(1))
        for a, b in blocks(offsets):
            found = _grams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)[1]
            yield found[winnow(found, size - size // 2 + 1)]

    shared = sketch.repeated(rows, keys, bits)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary(batch.column(1))
            ids, tags = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            parts = []
            for a, b in blocks(offsets):
                own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found = Contexts(own, places, size, shared.value, bits)
                if len(found.first):
                    document = np.searchsorted(places, found.first, "right") - 1
                    end = found.last + size
                    wide = own.astype(U64) + U64(1)
                    h1, h2 = range_hash(wide, found.first, end, WORD_BASE), range_hash(wide, found.first, end, WORD_BASE_2)
                    parts.append((document + a, found.first - places[document], found.last - places[document], found.anchor, h1, h2, _gather(own, found.first, end)))
            if parts:
                yield _settled(parts, ids, tags)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged, waiting, held = Merged(), [], 0
        for batch in batches:
            known = pa.compute.is_null(batch.column(5))
            if pa.compute.any(known).as_py():
                yield batch.filter(known).select(["doc_id", "tag", "first", "last"])
                batch = batch.filter(pa.compute.invert(known))
            for part in _cut(batch, shard_bytes):
                waiting.append(part)
                held += part.column(5).nbytes
                if held >= shard_bytes:
                    # the last anchor may go on in the next batch
                    table = pa.Table.from_batches(waiting)
                    anchors = table.column("anchor").to_numpy()
                    ready = int(np.searchsorted(anchors == anchors[-1], True)) if anchors[0] != anchors[-1] else 0
                    if ready:
                        yield _one(merged, table.slice(0, ready), None, size)
                        waiting = table.slice(ready).to_batches()
                        held = sum(w.column(5).nbytes for w in waiting)
                    if held >= shard_bytes:
                        yield _one(merged, pa.Table.from_batches(waiting), anchors[-1], size)
                        waiting, held = [], 0
        if waiting:
            yield _one(merged, pa.Table.from_batches(waiting), None, size)

    found = rows.mapInArrow(contexts, "anchor long, doc_id long, tag long, first int, last int, context binary")
    met = found.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "tag", "first")
    spans = met.mapInArrow(sort, "doc_id long, tag long, first int, last int")
    return spans.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def _cut(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of about `limit` bytes of contexts."""
    if len(batch):
        _, offsets = binary(batch.column(5))
        for a, b in blocks(offsets, limit):
            yield batch.slice(a, b - a)


def _one(merged: Merged, rows: pa.Table, goes_on: int | None, size: int) -> pa.RecordBatch:
    """Handles a shard; goes_on: the anchor that further shards may hold."""
    shard = Shard.of(rows)
    flags = shard.repeats(size)
    if merged.anchor is not None:
        merged.search(shard, flags, size)
    if goes_on is not None:
        merged.keep(shard, goes_on, flags, size)
    return _spans(shard, flags)


def deduplicate(docs: DataFrame, size: int = 100, bits: int = sketch.BITS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_bytes of every document."""
    spans = repeated_strings(docs, size, bits, shard_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = (text.as_py() or "").encode()
                n_bytes.append(len(data))
                runs = 0
                if spans.is_valid:
                    edge = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edge, spans.values.field(0).to_numpy(), 1)
                    np.add.at(edge, spans.values.field(1).to_numpy() + size, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                    data = np.frombuffer(data, np.uint8)[~gone].tobytes()
                n_removed.append(n_bytes[-1] - len(data))
                n_spans.append(runs)
                kept.append(data)
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)), pa.array(digests, pa.string()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    joined = rows.join(spans.hint("shuffle_hash"), ["doc_id", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents")).drop("kept_bytes")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op9_suffix_arrays": op9_suffix_arrays}
