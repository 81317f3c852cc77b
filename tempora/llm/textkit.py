"""Vectorised word segmentation and hashing shared by the corpus operators.

Texts stay in their Arrow buffers. A block of whole documents (never a part of
one) is segmented into words with a 256-entry byte table, and every word, and
every run of k words, gets a 64-bit hash from prefix sums of a polynomial, so
no Python code runs per word.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Odd multipliers of the polynomials (any odd number is invertible mod 2**64).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
WORD_BASE_2 = 0xA0761D6478BD642F

#: Bytes beyond which a word gets a digest in place of a polynomial.
LONG_WORD = 64

#: Bytes of text handled at once; a longer document makes a block of its own.
BLOCK_BYTES = 1 << 20


def byte_table(outside: str) -> np.ndarray:
    """True for the bytes that belong to words; `outside` picks the separators."""
    table = np.ones(256, bool)
    if outside == "space":  # words [^\x20\x09-\x0D]+
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif outside == "ascii_nonalnum":  # words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
        table[:0x80] = False
        table[0x30:0x3A] = True
        table[0x61:0x7B] = True
    else:
        raise ValueError(f"unknown word class {outside!r}")
    return table


SPACE_WORDS = byte_table("space")
ALNUM_WORDS = byte_table("ascii_nonalnum")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            steps = np.full(size, self.base, U64)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = self.inverse
            self.down = np.multiply.accumulate(steps)
        return self.up[:n], self.down[:n]


_POWERS = {b: _Powers(b) for b in (BYTE_BASE, WORD_BASE, WORD_BASE_2)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x = x * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each values[starts:ends]."""
    n = len(values)
    up, down = _POWERS[base].get(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Byte data and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes of text each."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end


class Words:
    """Words of a block of documents: byte places, document ranges, hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = False):
        base = int(offsets[0])
        self.offsets = offsets - base
        self.data = data[base : int(offsets[-1])]
        if lower:
            self.data = LOWER[self.data]
        inside = table[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        first = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        before[first] = False
        after[first[first > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        #: words of document d are first[d] up to first[d + 1]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        found = range_hash(self.data.astype(U64) + U64(1), self.starts, self.ends, BYTE_BASE)
        # polynomials mod 2**64 agree on some long words by construction, whatever the base
        for at in np.flatnonzero(self.ends - self.starts > LONG_WORD):
            found[at] = int.from_bytes(hashlib.blake2b(self.data[self.starts[at] : self.ends[at]].tobytes(), digest_size=8).digest(), "little")
        return found

    def windows(self, k: int) -> np.ndarray:
        """First words of all windows of k words that stay in one document."""
        n = len(self.starts)
        if n < k:
            return np.zeros(0, np.int64)
        document = np.repeat(np.arange(len(self.counts)), self.counts)
        return np.flatnonzero(document[: n - k + 1] == document[k - 1 :])


def window_hash(words: np.ndarray, at: np.ndarray, k: int, base: int = WORD_BASE) -> np.ndarray:
    return range_hash(words, at, at + k, base)


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Places that hold the smallest hash of any `span` neighbours around them.

    Two sequences with `span` equal neighbours in common both pick the same
    places among them, wherever the sequences stand.
    """
    n = len(hashes)
    if n < span:
        return np.zeros(0, np.int64)
    lowest = sliding(hashes, span, np.minimum, np.iinfo(U64).max)
    around = np.concatenate((np.zeros(span - 1, U64), lowest, np.zeros(span - 1, U64)))
    return np.flatnonzero(sliding(around, span, np.maximum, 0) == hashes)


def sliding(values: np.ndarray, span: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """pick.reduce of every `span` neighbours, from running values of blocks of `span`."""
    n = len(values)
    padded = np.full(-(-n // span) * span, fill, U64)
    padded[:n] = values
    table = padded.reshape(-1, span)
    left = pick.accumulate(table, axis=1).ravel()
    right = pick.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(right[: n - span + 1], left[span - 1 : n])


#: What this worker process keeps from task to task, by the operator that fills it.
_KEPT: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """The tables of one operator, until tasks of another begin in this process."""
    return _KEPT.setdefault(owner, {})


def _begin(owner: str) -> None:
    for other in [name for name in _KEPT if name != owner]:
        del _KEPT[other]
    _give_back()


def _give_back() -> None:
    """Free memory that Arrow and the C library hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow whose worker holds no tables of other operators, and no free memory when a task is over.

    Workers outlive their tasks, so without this an operator's memory adds to that of all before it.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(owner)
        try:
            yield from run(batches)
        finally:
            _give_back()

    return task


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share; set here only where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"file://{tempfile.gettempdir()}/tempora-shared"
    return folder.rstrip("/")


_SCOPES: list[list[str]] = []


def materialise(df: DataFrame, keep: bool = False) -> DataFrame:
    """Writes a table to the shared folder and reads it again: lineage ends here.

    Inside a scope() the table is removed with it, unless it is to be kept.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{uuid.uuid4().hex}"
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that are written inside, and lets Spark drop the shuffles behind them."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        release(spark)


def release(spark: SparkSession) -> None:
    """Lets Spark remove shuffle files that no table refers to any more.

    What the last job holds is free only a moment after it, so one pass would leave its files.
    """
    for pause in (0.5, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(pause)


def hash_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, those with the smallest hashes of key.

    A bound on the hash leaves about twice as many before they are ordered, however many there are.
    """
    total = rows.count()
    place = F.xxhash64(key)
    if total > 2 * most:
        rows = rows.where(place < -(1 << 63) + int((1 << 64) * (2 * most / total)))
    return rows.orderBy(place, key).limit(most)


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
