"""A count-min sketch of 64-bit keys whose counters stop at two.

Each batch of a task turns its keys into sparse counters, slice by slice; the
slices of all batches meet and merge in streams of bounded memory. What is kept
is, for every row of the sketch, the set of cells counted twice or more. A key's
estimate is the least of its counters, never below its true count (up to two),
so no repeated key is lost. The size is fixed by `bits`, whatever the corpus: a
fuller sketch lets more single keys through to the exact pass, and loses none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tempora.llm.textkit import U64, lean, mix

ROWS = 2
#: Cells of one row: 2 ** BITS; the set of a row then takes 2 ** (BITS - 3) bytes, 32 MB for both.
BITS = 27
#: Cells of one slice: 2 ** SLICE_BITS.
SLICE_BITS = 19

_SCHEMA = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(keys + U64((row + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U64(64 - bits)).astype(np.int64)


def repeated(docs: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = BITS) -> Broadcast:
    """The broadcast sets of cells counted twice or more; keys: arrays of keys of a batch of `docs`."""
    part = min(bits, SLICE_BITS)
    slices = ROWS << (bits - part)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([np.zeros(0, U64), *keys(batch)])
            rows: list[tuple[int, bytes, bytes]] = []
            for row in range(ROWS):
                at, times = np.unique(cells(found, row, bits), return_counts=True)
                number = (at >> part) + (row << (bits - part))
                local = (at & ((1 << part) - 1)).astype("<u4")
                edges = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True]))) if len(at) else np.zeros(1, int)
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    single = times[a:b] == 1
                    rows.append((int(number[a]), local[a:b][single].tobytes(), local[a:b][~single].tobytes()))
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in rows], schema=_SCHEMA)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number not in seen:
                    seen[number], twice[number] = np.zeros(1 << part, bool), np.zeros(1 << part, bool)
                once = np.frombuffer(one, "<u4")
                more = np.frombuffer(two, "<u4")
                twice[number][once[seen[number][once]]] = True
                twice[number][more] = True
                seen[number][once] = True
                seen[number][more] = True
        for number, flags in twice.items():
            packed = np.packbits(flags, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([packed], pa.binary())], names=["slice", "cells"])

    merged = docs.mapInArrow(lean(count), "slice int, once binary, twice binary").repartition("slice").mapInArrow(lean(merge), "slice int, cells binary")
    sets = np.zeros((slices, (1 << part) // 8 or 1), np.uint8)
    for row in merged.toLocalIterator():  # bounded: a set of each row of the sketch
        sets[row["slice"]] = np.frombuffer(bytes(row["cells"]), np.uint8)
    return docs.sparkSession.sparkContext.broadcast(sets.reshape(ROWS, -1))


def estimated_repeated(keys: np.ndarray, sets: np.ndarray, bits: int = BITS) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for row in range(ROWS):
        at = cells(keys, row, bits)
        found &= (sets[row][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def without(docs: DataFrame, ids: DataFrame, bits: int = 24) -> DataFrame:
    """The rows of docs, with all their columns, whose doc_id is none of ids (one column, long, no null).

    Only rows that the sketch can't clear meet ids in a shuffle; the others stay
    where they are. A null doc_id stays.
    """
    place, name = docs.columns.index("doc_id"), ids.columns[0]

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        own = batch.column(0).to_numpy().view(U64)
        yield np.concatenate((own, own))  # twice, so that the sketch tells them from others

    shared = repeated(ids, keys, bits)

    def part(held: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(place).cast(pa.int64())
                known = column.is_valid().to_numpy(zero_copy_only=False)
                flags = known & estimated_repeated(column.fill_null(0).to_numpy().view(U64), shared.value, bits)
                yield batch.filter(pa.array(flags == held))

        return docs.mapInArrow(lean(run), docs.schema)

    open_rows = part(True)
    return part(False).union(open_rows.join(ids, open_rows["doc_id"].cast("long") == ids[name], "left_anti"))
