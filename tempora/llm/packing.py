"""Vector bin packing of token sequences.

Every task packs the documents of its own partition as they stream by, so
nothing is shuffled and a lost task is simply run again. A document is first cut
into full sequences; what is left over joins a bounded pool of items, each a
vector of (tokens, segments, loss-bearing tokens). A sequence takes, again and
again, the item that fits its remaining capacity and has the largest dot product
with it; where none fits any more, the item with the largest dot product is cut
to fill the rest. What cannot fill a last sequence is laid out in sequences whose
lengths are powers of two, which need no padding either.

Defined results: a null or empty text is its end mark alone; a null doc_id stays
null; equal rows are packed one by one; every id lies in exactly one piece.
Sequence numbers are unique over the whole result, with gaps between partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.textkit import id_and_text, kept, lean, read_table

#: Words remembered by one Python worker; memory stays below about 250 MB.
REMEMBERED = 1_200_000


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold at most; pool is the number of items to choose from."""

    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096
    pool: int = 512


class WordIds(dict):
    """Little-endian 32-bit ids of words between ASCII white space, made when first asked for.

    The tokenizer drops white space and never joins characters over it, so a
    text's ids are those of its words in order.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))

    def __missing__(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        found = np.array(ids, "<u4").tobytes()
        if len(word) <= 64:
            self[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        return b"".join(map(self.__getitem__, (text or "").encode().split()))


def _word_ids(vocabulary: str) -> WordIds:
    """One table a worker process, whatever the number of its tasks."""
    tables = kept("packing")
    if vocabulary not in tables:
        tables[vocabulary] = WordIds(vocabulary)
    return tables[vocabulary]


@dataclass
class Document:
    doc_id: int | None
    ids: bytes
    total: int
    silent: int  # leading ids that bear no loss

    def loss(self, start: int, length: int) -> int:
        """Loss-bearing ids of a piece; the end mark bears none."""
        end = min(start + length, self.total - 1)
        return max(0, end - max(start, self.silent))


Piece = tuple[Document, int, int]  # document, start, length


class Packer:
    """Packs pieces as they come; `done` collects finished sequences."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.room = limits.pool
        self.items: list[Piece | None] = [None] * self.room
        self.vectors = np.full((self.room, 3), np.inf)
        self.free = list(range(self.room))
        self.done: list[list[Piece]] = []

    def add(self, document: Document) -> None:
        at, most = 0, self.limits.tokens
        while document.total - at >= most and document.loss(at, most) <= self.limits.loss_tokens:
            self.done.append([(document, at, most)])
            at += most
        while at < document.total:
            length = min(most, document.total - at)
            while document.loss(at, length) > self.limits.loss_tokens:
                length -= document.loss(at, length) - self.limits.loss_tokens
            self._put((document, at, length))
            at += length

    def _put(self, piece: Piece) -> None:
        while not self.free:
            self._fill()
        slot = self.free.pop()
        self.items[slot] = piece
        self.vectors[slot] = (piece[2], 1, piece[0].loss(*piece[1:]))

    def _take(self, slot: int) -> Piece:
        piece = self.items[slot]
        self.items[slot] = None
        self.vectors[slot] = np.inf
        self.free.append(slot)
        return piece

    def _fill(self) -> None:
        """Closes one sequence."""
        left = self.capacity.copy()
        pieces: list[Piece] = []
        while left[0] > 0 and left[1] > 0 and len(self.free) < self.room:
            weight = left / self.capacity**2
            fits = (self.vectors <= left).all(axis=1)
            if fits.any():
                slot = int(np.argmax(np.where(fits, np.where(fits[:, None], self.vectors, 0) @ weight, -1)))
                piece = self._take(slot)
            else:
                used = np.isfinite(self.vectors[:, 0])
                slot = int(np.argmax(np.where(used, np.where(used[:, None], self.vectors, 0) @ weight, -1)))
                document, start, length = self.items[slot]
                cut = min(int(left[0]), length - 1)
                while cut > 0 and document.loss(start, cut) > left[2]:
                    cut -= int(document.loss(start, cut) - left[2])
                if cut <= 0:
                    break
                piece = (document, start, cut)
                self.items[slot] = (document, start + cut, length - cut)
                self.vectors[slot] = (length - cut, 1, document.loss(start + cut, length - cut))
            pieces.append(piece)
            left -= (piece[2], 1, piece[0].loss(*piece[1:]))
        self._close(pieces)

    def _close(self, pieces: list[Piece]) -> None:
        total = sum(p[2] for p in pieces)
        if total == self.limits.tokens:
            self.done.append(pieces)
            return
        pieces = pieces[::-1]
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            part: list[Piece] = []
            while size:
                document, start, length = pieces.pop()
                if length > size:
                    pieces.append((document, start + size, length - size))
                    length = size
                part.append((document, start, length))
                size -= length
            self.done.append(part)

    def finish(self) -> None:
        while len(self.free) < self.room:
            self._fill()


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64())])


def pack(docs: DataFrame, vocabulary: str, limits: Limits = Limits(), end_id: int = 2, silent_column: str | None = None) -> DataFrame:
    """Pieces of all documents with the sequence and the offset that each takes.

    silent_column: names a column with the number of leading ids of a document
    that bear no loss (an instruction's prompt); without it all ids but the end
    mark bear loss.
    """
    silent = F.coalesce(F.col(silent_column).cast("long"), F.lit(0).cast("long")) if silent_column else F.lit(0).cast("long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = _word_ids(vocabulary), Packer(limits)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, text, quiet in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                ids = words.encode(text.as_py()) + end
                packer.add(Document(doc_id, ids, len(ids) // 4, quiet))
                if len(packer.done) >= 512:
                    yield _rows(packer.done, number)
                    number += len(packer.done)
                    packer.done = []
        packer.finish()
        yield _rows(packer.done, number)

    return id_and_text(docs, silent.alias("silent")).mapInArrow(lean(run, "packing"), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long")


def _rows(sequences: list[list[Piece]], number: int) -> pa.RecordBatch:
    rows: list[tuple] = []
    for i, pieces in enumerate(sequences):
        offset = 0
        for document, start, length in pieces:
            crc = zlib.crc32(memoryview(document.ids)[4 * start : 4 * (start + length)])
            rows.append((document.doc_id, start, length, crc, document.total, number + i, offset, document.loss(start, length)))
            offset += length
    columns = zip(*rows, strict=True) if rows else [[] for _ in _SCHEMA]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SCHEMA)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op2_packing": op2_packing}
