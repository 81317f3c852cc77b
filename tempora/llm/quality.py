"""Quality verdicts: rule statistics, an isolation forest over them, calibrated thresholds.

One pass over the texts gives every document its statistics. Trees of random
splits are grown on statistics of labelled good documents; a document that they
isolate after few splits is unlike those. The path length that separates good
from bad is read off the labelled rows: of the thresholds that reject at most
`most_good_lost` of the labelled good documents, the one that agrees with most
labels. Documents that fail the base rules are rejected whatever their score.

Box, trees and threshold come from all labelled rows, however many: the box by
their extremes, each tree by its own draw from every good row (a draw of SAMPLE
rows a tree is what an isolation forest is), the threshold exactly, by running
counts over all their scores. None of them travels to the driver but the draws of
the trees and sums of at most CELLS cells.

Defined results: null, empty and wordless texts have no words and fail the base
rules; a null doc_id stays null and is never a labelled row; equal rows give
equal result rows; without labels of both kinds the forest rejects nothing; with
several labels of one document each is a labelled row; equal rows count once in
the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.textkit import SPACE_WORDS, U64, Words, binary, blocks, id_and_text, lean, materialise, mix, read_table, window_hash

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the trees split on.
FEATURES = ("log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate", "mark_rate", "distinct_rate", "bar_rate", "words_per_line")
SYMBOLS = b"#*$%&|<>"
#: Trees of a forest and rows that each of them draws.
TREES, SAMPLE = 200, 256
#: Ranges of scores, for running counts.
CELLS = 1 << 16


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_IS_SYMBOL = _table(SYMBOLS)
_IS_UPPER = _table(bytes(range(0x41, 0x5B)))
_IS_DIGIT = _table(bytes(range(0x30, 0x3A)))
_IS_MARK = _table(b"!?;:")
_IS_BAR = _table(b"|")
_IS_LINE = _table(b"\n")
_BEGINS_CHAR = (np.arange(256) & 0xC0) != 0x80


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])


def block_statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS and FEATURES of the documents of one block, a row each."""
    words = Words(data, offsets, SPACE_WORDS)
    data, offsets, n = words.data, words.offsets, words.counts
    edge = np.zeros(len(data) + 1, np.int8)
    edge[words.starts] += 1
    edge[words.ends] -= 1
    in_word = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    chars = _per_document(in_word & _BEGINS_CHAR[data], offsets)
    symbols = _per_document(_IS_SYMBOL[data], offsets)
    lines = _per_document(_IS_LINE[data], offsets) + 1
    hashes = words.hashes()
    document = np.repeat(np.arange(len(n)), n)

    at = words.windows(8)
    key = mix(window_hash(hashes, at, 8) + document[at].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = (key[order][1:] == key[order][:-1]) & (document[at][order][1:] == document[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + 8, -1)
    repeated = np.diff(np.concatenate(([0], np.cumsum(np.cumsum(cover)[:-1] > 0)))[words.first])

    dup_lines = np.zeros(len(n), np.int64)
    raw = data.tobytes()
    for i in np.flatnonzero((lines > 1) & (n > 1)):
        parts = [part for part in raw[offsets[i] : offsets[i + 1]].split(b"\n") if part.strip()]
        dup_lines[i] = len(parts) - len(set(parts))

    pair = np.lexsort((hashes, document))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[pair][1:] != hashes[pair][:-1]) | (document[pair][1:] != document[pair][:-1])
    distinct = np.bincount(document[pair][fresh], minlength=len(n))

    some, letters = np.maximum(n, 1), np.maximum(chars, 1)
    counts = np.stack((n, chars, symbols, dup_lines, repeated), axis=1).astype(np.int64)
    features = np.stack(
        (
            np.log1p(n), chars / some, symbols / letters, dup_lines / np.maximum(lines, 1), repeated / some, _per_document(_IS_UPPER[data], offsets) / letters,
            _per_document(_IS_DIGIT[data], offsets) / letters, _per_document(_IS_MARK[data], offsets) / letters, distinct / some, _per_document(_IS_BAR[data], offsets) / some, np.log1p(n / lines),
        ),
        axis=1,
    )
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])


def batch_statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = binary(column)
    parts = [block_statistics(data, offsets[a : b + 1]) for a, b in blocks(offsets)]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, FEATURES and base_failed of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = batch_statistics(batch.column(1))
            columns = [batch.column(0), *map(pa.array, counts.T), *map(pa.array, features.T), pa.array(base_failed(counts))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, *FEATURES, "base_failed"])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), *(f"{f} double" for f in FEATURES), "base_failed boolean"])
    return id_and_text(docs).mapInArrow(lean(run), schema)


@dataclass
class Forest:
    """Random split trees in flat arrays; leaves point at themselves."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    sample: int
    depth: int
    threshold: float = np.inf

    @classmethod
    def grow(cls, draws: list[np.ndarray], floor: np.ndarray, ceiling: np.ndarray, seed: int = 7) -> Forest:
        """A tree on each draw of rows; cuts fall into the range of the rows, or of all of the box inside the node's.

        The second kind parts off empty space: what lies there is isolated
        early, even in a statistic that hardly varies between the rows.
        """
        rng = np.random.default_rng(seed)
        trees, sample = len(draws), max(len(draw) for draw in draws)
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))) + 2)
        size = 1 << (depth + 1)
        feature = np.zeros((trees, size), np.int64)
        split = np.full((trees, size), np.inf)
        child = np.tile(np.arange(size), (trees, 1))
        path = np.zeros((trees, size))
        varied = np.flatnonzero(ceiling > floor)
        for tree, draw in enumerate(draws):
            todo = [(1, draw, floor, ceiling, 0)]
            while todo:
                node, own, low, high, level = todo.pop()
                if level == depth or len(own) <= 1 or not len(varied):
                    path[tree, node] = level + _mean_path(len(own))
                    continue
                f = int(rng.choice(varied))
                near, far = (own[:, f].min(), own[:, f].max()) if rng.random() < 0.5 else (low[f], high[f])
                if near == far:
                    near, far = low[f], high[f]
                cut = rng.uniform(near, far)
                feature[tree, node], split[tree, node], child[tree, node] = f, cut, 2 * node
                left = own[:, f] < cut
                below, above = high.copy(), low.copy()
                below[f] = above[f] = cut
                todo += [(2 * node, own[left], low, below, level + 1), (2 * node + 1, own[~left], above, high, level + 1)]
        return cls(feature, split, child, path, sample, depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; near 1: isolated after few splits."""
        total = np.zeros(len(rows))
        place = np.arange(len(rows))
        for feature, split, child, path in zip(self.feature, self.split, self.child, self.path, strict=True):
            node = np.ones(len(rows), np.int64)
            for _ in range(self.depth):
                down = child[node]
                inner = down != node
                node = np.where(inner, down + (rows[place, feature[node]] >= split[node]), node)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / max(_mean_path(self.sample), 1e-9))


def _mean_path(n: int) -> float:
    """Mean depth at which n random rows are told apart."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def _draws(good: DataFrame, total: int) -> list[np.ndarray]:
    """For each tree the SAMPLE rows of all good ones with the smallest hashes of row and tree.

    A bound on the hashes leaves about twice as many before they are ordered, however many rows there are.
    """
    bound = (1 << 64) - 1 if total <= 2 * SAMPLE else int((1 << 64) * (2 * SAMPLE / total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column(0).to_numpy().view(U64)
            key = mix(place[:, None] + mix(np.arange(1, TREES + 1, dtype=U64)))
            row, tree = np.nonzero(key <= U64(bound))
            columns = [pa.array(tree.astype(np.int32)), pa.array(key[row, tree].view(np.int64)), *(c.take(pa.array(row)) for c in batch.columns[1:])]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "key", *FEATURES])

    found = good.select(F.xxhash64("doc_id", *FEATURES), *FEATURES).mapInArrow(lean(run), ", ".join(["tree int, key long", *(f"{f} double" for f in FEATURES)])).toArrow()
    tree, key = found["tree"].to_numpy(), found["key"].to_numpy().view(U64)
    rows = np.stack([found[f].to_numpy() for f in FEATURES], axis=1)
    order = np.lexsort((*rows.T, key, tree))
    edges = np.searchsorted(tree[order], np.arange(TREES + 1))
    return [rows[order[a : min(b, a + SAMPLE)]] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def threshold(scored: DataFrame, n_good: int, most_good_lost: float) -> float:
    """Of the scores, as cuts, the smallest that agrees with most labels and loses at most that share of the good rows."""
    steps = scored.groupBy("score").agg(F.sum("quality").alias("good"), F.count("*").alias("rows"))
    steps = materialise(steps.select("score", F.floor(F.col("score") * CELLS).cast("int").alias("cell"), "good", (F.col("rows") - F.col("good")).alias("bad")))
    # what lies above: of other cells (at most CELLS + 1 rows in one task), then of the own one
    above = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    cells = steps.groupBy("cell").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    cells = cells.select("cell", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in "gb"))
    own = Window.partitionBy("cell").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = steps.join(F.broadcast(cells), "cell").select("score", (F.sum("good").over(own) + F.col("g_above")).alias("lost"), (F.sum("bad").over(own) + F.col("b_above")).alias("gained"))
    best = cuts.where((F.col("lost") / n_good <= most_good_lost) & (F.col("gained") > F.col("lost"))).orderBy(F.desc(F.col("gained") - F.col("lost")), "score").first()
    return np.inf if best is None else best["score"]


def fit(stats: DataFrame, labels: DataFrame, most_good_lost: float = 0.001) -> Forest:
    """Grows the forest and calibrates its threshold on all labelled rows; equal rows count once."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality is not null and doc_id is not null")
    known = materialise(stats.where("not base_failed").join(marks.distinct(), "doc_id").select("doc_id", (F.col("quality") == 1).cast("int").alias("quality"), *FEATURES).distinct())
    sides = [F.count("*").alias("n"), F.sum("quality").alias("good"), *(F.min(f).alias(f"low {f}") for f in FEATURES), *(F.max(f).alias(f"high {f}") for f in FEATURES)]
    box = known.agg(*sides).first()
    n_good = box["good"] or 0
    if n_good < 8 or n_good == box["n"]:
        return Forest.grow([np.zeros((2, len(FEATURES)))], np.zeros(len(FEATURES)), np.zeros(len(FEATURES)))
    floor, ceiling = (np.array([box[f"{side} {f}"] for f in FEATURES]) for side in ("low", "high"))
    forest = Forest.grow(_draws(known.where("quality = 1"), n_good), floor, ceiling)
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(_feature_rows(batch)))], names=["quality", "score"])

    forest.threshold = threshold(known.select("quality", *FEATURES).mapInArrow(lean(run), "quality int, score double"), n_good, most_good_lost)
    return forest


def _feature_rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)


def verdicts(stats: DataFrame, forest: Forest) -> DataFrame:
    """Adds the anomaly score and the verdict to a table of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(_feature_rows(batch))
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            kept = ~failed & (scores < shared.value.threshold)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", *COUNTS, "base_failed")), pa.array(kept), pa.array(scores)], names=["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    return stats.mapInArrow(lean(run), ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean, kept boolean, anomaly double"]))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that the verdict keeps; texts are never shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(statistics(docs), labels))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = batch_statistics(batch.column(place))
            kept = ~base_failed(counts) & (shared.value.score(features) < shared.value.threshold)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(lean(run), docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialise(statistics(read_table(spark, sf_dir, "documents")))
    return verdicts(stats, fit(stats, read_table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op4_quality": op4_quality}
