"""Toxicity scores from a learned lexicon, misspellings included, weighed by context.

The lexicon is learned: words, or stems that begin many words, that stand in
toxic training documents and hardly ever in others. Its terms stand in a trie.
Every token of a text is the pattern of a Levenshtein automaton, simulated with
one bit set for each number of errors, and the automaton and the trie are walked
together, so one walk finds all terms within reach of a misspelled token. Around
each match a window of words tells whether it stands between quotation marks and
how many further matches are near: mentions count apart from abuse. A logistic
model over these counts gives the score.

Everything is fitted on at most `sample_rows` labelled rows, those with the
smallest hash of doc_id among rows whose crc32(doc_id) mod 3 is not 1; scores
cover every document. Only the text is an input of a score.

Defined results: null and empty texts score like a text without any match; a
null doc_id is never a training row and not held out; of several labels of one
doc_id the larger counts; equal rows give equal result rows; without toxic and other training rows every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.textkit import hash_sample, id_and_text, materialise, read_table

TOKEN = re.compile(r"[^\W_]+")
#: Marks the end of a word in the trie and in counts of stems.
END = "$"
#: Letters of the longest stem.
LONGEST = 40
OPENING, CLOSING = '"“«„‟‹', '"”»“›'
#: Words on either side of a match that make its context.
CONTEXT = 8
#: Tokens remembered by one Python worker; memory stays below about 150 MB.
REMEMBERED = 1_000_000


def errors_allowed(term: str) -> int:
    """Short terms match as they are; longer ones, words and stems alike, with one error, from eight letters on with two."""
    n = len(term.rstrip(END))
    return 0 if n < 5 else 1 if n < 8 else 2


class Lexicon:
    """Terms in a trie; a term that ends with END is a word, any other one a stem."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        #: node: char -> [terms below as bits, most errors allowed below, node]; "" -> terms that end here
        self.trie: dict = {}
        # with at most k errors one of k + 1 parts of a term stands in the token unchanged, at most k places away
        self.spots: dict[str, dict[int, int]] = {}
        for number, term in enumerate(terms):
            plain, k, bit = term.rstrip(END), errors_allowed(term), 1 << number
            node = self.trie
            for char in plain:
                entry = node.setdefault(char, [0, 0, {}])
                entry[0] |= bit
                entry[1] = max(entry[1], k)
                node = entry[2]
            node.setdefault("", []).append((bit, k, term))
            edges = [round(i * len(plain) / (k + 1)) for i in range(k + 2)]
            for a, b in zip(edges, edges[1:], strict=False):
                at = self.spots.setdefault(plain[a:b], {})
                for i in range(max(0, a - k), a + k + 1):
                    at[i] = at.get(i, 0) | bit
        self.lengths = sorted({len(part) for part in self.spots})
        self.reach = 1 + max((max(at) for at in self.spots.values()), default=-1)
        self.most = max(map(errors_allowed, terms), default=0)

    def candidates(self, token: str) -> int:
        """Bits of the terms that the token may spell; none of the others can."""
        spots, found = self.spots, 0
        for n in self.lengths:
            for i in range(min(self.reach, len(token) - n + 1)):
                at = spots.get(token[i : i + n])
                if at is not None:
                    found |= at.get(i, 0)
        return found

    def match(self, token: str) -> tuple[int, str] | None:
        """The fewest errors, and the term, of the terms that the token spells; None if none."""
        wanted = self.candidates(token)
        if not wanted:
            return None
        n = len(token)
        places: dict[str, int] = {}
        for i, char in enumerate(token):
            places[char] = places.get(char, 0) | 1 << i
        full = (1 << (n + 1)) - 1
        best: tuple[int, str] | None = None
        start = [(1 << (e + 1)) - 1 & full for e in range(self.most + 1)]
        stack = [(self.trie, start)]
        while stack:
            node, states = stack.pop()
            for char, below in node.items():
                if char == "":
                    for bit, k, term in below:
                        for e in range(k + 1) if bit & wanted else ():
                            # a word ends with the token; a stem may go on
                            if states[e] & (1 << n if term[-1] == END else full) and (best is None or (e, term) < best):
                                best = (e, term)
                    continue
                terms, most, child = below
                if not terms & wanted:
                    continue
                here = places.get(char, 0)
                now = [(states[0] & here) << 1]
                for e in range(1, most + 1):
                    # same character; another one; one missing in the token; one too many in it
                    now.append(((states[e] & here) << 1 | states[e - 1] << 1 | states[e - 1] | now[e - 1] << 1) & full)
                if any(now):
                    stack.append((child, now))
        return best


#: One row a document: what the logistic model sees.
FEATURES = ("terms", "exact", "exact_quoted", "near", "near_quoted", "density", "crowd", "length")


@dataclass
class Scorer:
    lexicon: Lexicon
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    fitted: bool = False
    known: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "lexicon": self.lexicon.terms}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state | {"lexicon": Lexicon(state["lexicon"])})

    def features(self, text: str | None) -> list[float]:
        lowered = (text or "").lower()
        tokens = TOKEN.findall(lowered)
        known, match = self.known, self.lexicon.match
        fresh = {t for t in tokens if t not in known} if tokens else ()
        if fresh:
            if len(known) > REMEMBERED:
                known.clear()
                fresh = set(tokens)
            for token in fresh:
                known[token] = match(token)
        hits = [i for i, t in enumerate(tokens) if known[t] is not None]
        if not hits:
            return [0, 0, 0, 0, 0, 0, 0, np.log1p(len(tokens))]
        spans = [m.span() for m in TOKEN.finditer(lowered)]
        counts: Counter = Counter()
        terms = set()
        crowd, left = 0, 0
        for right, i in enumerate(hits):
            while hits[left] < i - CONTEXT:
                left += 1
            crowd = max(crowd, right - left + 1)
            before = lowered[spans[max(0, i - CONTEXT)][0] : spans[i][0]]
            after = lowered[spans[i][1] : spans[min(len(spans) - 1, i + CONTEXT)][1]]
            errors, term = known[tokens[i]]
            terms.add(term)
            counts[errors > 0, _quoted(before, after)] += 1
        rest = [counts[False, False], counts[False, True], counts[True, False], counts[True, True], 100 * len(hits) / len(tokens), crowd, len(tokens)]
        return [float(np.log1p(x)) for x in (len(terms), *rest)]

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.zeros(len(rows))
        z = ((rows - self.centre) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def fit(self, rows: np.ndarray, toxic: np.ndarray, penalty: float = 1.0) -> None:
        """Logistic regression by Newton steps."""
        if not (0 < toxic.sum() < len(toxic)):
            return
        self.centre, self.scale = rows.mean(0), np.maximum(rows.std(0), 1e-6)
        x = np.column_stack((np.ones(len(rows)), (rows - self.centre) / self.scale))
        pull = np.eye(x.shape[1]) * penalty
        pull[0, 0] = 0
        w = np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * np.maximum(p * (1 - p), 1e-9)[:, None]) + pull, x.T @ (toxic - p) - pull @ w)
            w += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-6:
                break
        self.weights, self.fitted = w, True


def _quoted(before: str, after: str) -> bool:
    """A quotation opens before the match and closes after it."""
    opened = max(map(before.rfind, OPENING)) > max(map(before.rfind, CLOSING.replace('"', "")))
    if '"' in before:
        opened = before.count('"') % 2 == 1 or opened and before.rfind('"') < 0
    return opened and any(mark in after for mark in CLOSING)


def learn_terms(sample: DataFrame, least: int = 4, purity: float = 0.8) -> list[str]:
    """Words and stems of at least three letters that mark toxic documents of a bounded sample.

    A term stands in at least `least` toxic documents, copies of a document counted
    once (toxic if any copy is), and in few others; a word gives stems of up to
    LONGEST letters. However many terms pass that test, all of them count.
    """
    sample = materialise(sample.groupBy("text").agg(F.max("toxic").alias("toxic")))

    def stems(text: str | None) -> set[str]:
        words = set(TOKEN.findall((text or "").lower()))
        return {w[:n] for word in words for w in ((word + END)[:LONGEST],) for n in range(3, len(w) + 1) if w[n - 1] != END or n > 3}

    def count(wanted: frozenset | None) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            toxic: Counter = Counter()
            other: Counter = Counter()
            for batch in batches:
                for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                    if label or wanted is not None:
                        found = stems(text.as_py())
                        (toxic if label else other).update(found if wanted is None else found & wanted)
            names = list({*toxic, *other})
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[s] for s in names], pa.int64()), pa.array([other[s] for s in names], pa.int64())], names=["stem", "toxic", "other"])

        return run

    def totals(wanted: frozenset | None) -> DataFrame:
        rows = sample.select("text", "toxic").mapInArrow(count(wanted), "stem string, toxic long, other long")
        return rows.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") >= least)

    wanted = frozenset(r["stem"] for r in totals(None).select("stem").collect())  # bounded by the sample
    counts = {r["stem"]: (r["toxic"], r["other"]) for r in totals(wanted).collect()}
    pure = {s: t for s, (t, o) in counts.items() if t >= purity * (t + o)}
    chosen: list[str] = []
    covered: set[str] = set()
    for stem in sorted(pure, key=lambda s: (len(s), s)):
        if any(stem[:n] in covered for n in range(3, len(stem))):
            continue
        covered.add(stem)
        # a stem is as long as nearly all words that begin with it are alike
        longer = stem
        while True:
            best = max((s for s in pure if len(s) == len(longer) + 1 and s.startswith(longer)), key=lambda s: pure[s], default=None)
            if best is None or pure[best] < 0.95 * pure[stem]:
                break
            longer = best
        chosen.append(longer)
    return sorted(chosen, key=lambda s: (-pure[s], s))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 16_000) -> Scorer:
    marks = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_sample(marks, "doc_id", sample_rows)
    sample = materialise(id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic"))  # at most sample_rows pairs are broadcast
    scorer = Scorer(Lexicon(learn_terms(sample)))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([shared.value.features(t.as_py()) for t in batch.column(0)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*map(pa.array, rows.T), batch.column(1)], names=[*FEATURES, "toxic"])

    table = np.array([tuple(r) for r in sample.mapInArrow(run, ", ".join([*(f"{f} double" for f in FEATURES), "toxic int"])).collect()], float).reshape(-1, len(FEATURES) + 1)
    scorer.fit(table[:, :-1], table[:, -1])
    return scorer


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of matched terms of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([shared.value.features(t.as_py()) for t in batch.column(1)], float).reshape(-1, len(FEATURES))
            scores = shared.value.score(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(np.rint(np.expm1(rows[:, 0])).astype(np.int64))], names=["doc_id", "score", "predicted", "n_terms"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, n_terms long")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "n_terms")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op6_toxicity": op6_toxicity}
