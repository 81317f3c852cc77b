"""Token counts of a piece vocabulary by heap-and-linked-list byte-pair merging.

A text's symbols stand in a linked list; a heap holds the adjacent pairs that
form a piece, and the pair of lowest rank (leftmost of equal ones) is merged
again and again. The count is the number of initial symbols minus the merges,
plus, for each symbol left over that is no piece, its further UTF-8 bytes, since
those fall back to byte pieces. No identifiers are made.

Texts are cut before they are merged wherever two neighbouring characters stand
together inside no piece: no merge can cross such a place, so the parts count
alone and equal parts count once. Whole texts are counted.

Defined results: null counts as empty and has 0 bytes and 0 tokens; a null
doc_id stays null; equal rows give equal result rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tempora.llm.textkit import id_and_text, kept, lean, read_table

SPACE = "▁"
#: Parts remembered by one Python worker; memory stays below about 250 MB.
REMEMBERED = 1_500_000


class PieceCounter(dict):
    """Token counts by part of a text, counted when first asked for."""

    def __init__(self, ranks: dict[str, int], remembered: int = REMEMBERED):
        self.ranks, self.remembered = ranks, remembered
        self.pairs = {piece[i : i + 2] for piece in ranks for i in range(len(piece) - 1)}
        self.single = {piece for piece in ranks if len(piece) == 1}
        inner = {pair[0] for pair in self.pairs} | {pair[1] for pair in self.pairs}
        # pieces that hold a space mark after something else would forbid the first cut
        self.cuts = not any(pair[1] == SPACE != pair[0] for pair in self.pairs) and "\n" not in inner
        self.parts = re.compile(rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n").findall

    @classmethod
    def from_model(cls, path: str) -> PieceCounter:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        kept = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)))
        return cls({model.id_to_piece(i): round(-model.get_score(i)) for i in kept})

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(self) > self.remembered:
            self.clear()
        return sum(map(self.__getitem__, self.parts(text))) if self.cuts else self.merged(text)

    def __missing__(self, part: str) -> int:
        pairs = self.pairs
        cuts = [i for i, pair in enumerate(map(add, part, part[1:]), 1) if pair not in pairs]
        if cuts:
            edges = [0, *cuts, len(part)]
            found = sum(self[part[a:b]] for a, b in zip(edges, edges[1:], strict=False))
        else:
            found = self.merged(part)
        if len(part) <= 64:
            self[part] = found
        return found

    def merged(self, part: str) -> int:
        n = len(part)
        rank_of = self.ranks.get
        shift = n.bit_length()
        place = (1 << shift) - 1
        symbols: list[str | None] = list(part)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [rank << shift | i for i in range(n - 1) if (rank := rank_of(part[i : i + 2])) is not None]
        heapify(heap)
        left_over = n
        while heap:
            top = heappop(heap)
            i = top & place
            symbol, j = symbols[i], after[i]
            if symbol is None or j == n:
                continue
            symbol += symbols[j]
            if rank_of(symbol) != top >> shift:  # a neighbour has been merged since
                continue
            symbols[i], symbols[j] = symbol, None
            left_over -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(symbol + symbols[k])) is not None:
                    heappush(heap, rank << shift | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] + symbol)) is not None:
                heappush(heap, rank << shift | h)
        if self.single.issuperset(part):
            return left_over
        return left_over + sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in self.ranks)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; vocabulary: a file name of public_tokenizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            sizes = np.array([0 if t is None else counter.count(t) for t in map(pa.StringScalar.as_py, texts)], np.int64)
            n_bytes = texts.cast(pa.binary()).fill_null(b"") if texts.null_count else texts.cast(pa.binary())
            lengths = pa.compute.binary_length(n_bytes).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), lengths, pa.array(sizes), pa.array(sizes > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs).mapInArrow(lean(run, "tokens"), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _counter(vocabulary: str) -> PieceCounter:
    """One counter a worker process, whatever the number of its tasks."""
    counters = kept("tokens")
    if vocabulary not in counters:
        import public_tokenizers

        counters[vocabulary] = PieceCounter.from_model(public_tokenizers.path(vocabulary))
    return counters[vocabulary]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_token_counts": op1_token_counts}
