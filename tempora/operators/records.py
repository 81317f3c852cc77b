"""Checks and assembly of transcript records and planned cues."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.functions.text import compact, repetition_loops
from tempora.operators import intervals as iv
from tempora.operators.sequence import candidate_boundaries, fold_groups

SECOND = 1_000_000


def embeddable(df: DataFrame, shortest: int = 2 * SECOND, longest: int = 15 * SECOND, longest_separated: int = 30 * SECOND) -> DataFrame:
    """Regions fit for an embedding: long enough, not too long, and not raw overlap."""
    length = F.col("e") - F.col("s")
    separated = F.col("source_path").isNotNull()
    return df.where((length >= shortest) & (length <= F.when(separated, longest_separated).otherwise(longest)) & (separated | ~F.coalesce("overlap", F.lit(False))))


def healthy_records(records: DataFrame, keys: Sequence[str] = ("job", "rec_ix")) -> DataFrame:
    """Adds `healthy` to records (core_start_us, core_end_us, text, cues, skipped_empty).

    No repetition loop, every cue ends after it starts, long texts spread over
    time and don't begin at one moment. A record skipped as empty is healthy.
    """
    cues = F.coalesce("cues", F.array().cast(records.schema["cues"].dataType.simpleString()))
    n = F.size(cues)
    ordered = F.forall(cues, lambda c: (c["end_us"] > c["start_us"]) & (F.trim(c["text"]) != ""))
    starts = F.transform(cues, lambda c: F.round(c["start_us"] / 100_000))
    most = F.array_max(F.transform(F.array_distinct(starts), lambda s: F.size(F.filter(starts, lambda x: x == s))))
    length = F.col("core_end_us") - F.col("core_start_us")
    span = F.array_max(F.transform(cues, lambda c: c["end_us"])) - F.array_min(F.transform(cues, lambda c: c["start_us"]))
    long = F.length(compact(F.col("text"))) >= 20
    spread = ~long | (F.coalesce(span, F.lit(0)) >= F.least(F.lit(float(SECOND)), 0.25 * length))
    apart = (n < 20) | (10 * most < 8 * n)
    healthy = F.coalesce("skipped_empty", F.lit(False)) | ((n > 0) & ordered & repetition_loops(F.col("text")).isNull() & spread & apart)
    return records.withColumn("healthy", F.coalesce(healthy, F.lit(False)))


def dense(windows: DataFrame, spans: DataFrame, most_silence: int = 15 * SECOND, least: float = 0.6, keys: Sequence[str] = ("job",)) -> DataFrame:
    """Windows (rid, s, e) that spans cover well, with at most `most_silence` of silence in all; none without length."""
    length = F.col("e") - F.col("s")
    covered = iv.coverage(windows, spans, keys)
    return covered.where((length > 0) & (length - F.col("covered") <= most_silence) & (F.col("covered") >= least * length)).drop("covered")


def boundary_specs(plan: DataFrame, windows: DataFrame, keys: Sequence[str] = ("job",)) -> DataFrame:
    """Neighbouring records of one plan that touch where one window ends and the next begins.

    plan: start_id, end_id; windows: start_id, end_id. Gives left_start, left_end, right_end.
    """
    following = plan.withColumn("right_start", F.lead("start_id").over(Window.partitionBy(*keys).orderBy("start_id"))).withColumn("right_end", F.lead("end_id").over(Window.partitionBy(*keys).orderBy("start_id")))
    edges = windows.select(*keys, F.col("end_id").alias("edge"))
    met = following.join(edges, [*(following[k] == edges[k] for k in keys), following["end_id"] == edges["edge"]])
    return met.where("right_start = end_id + 1").select(*(following[k] for k in keys), F.col("start_id").alias("left_start"), F.col("end_id").alias("left_end"), "right_end")


def splice(plan: DataFrame, specs: DataFrame, repaired: DataFrame, keys: Sequence[str] = ("job",)) -> DataFrame:
    """The plan with the records on both sides of each repaired boundary replaced.

    repaired: left_start, right_end, start_id, end_id. A spec without records stays.
    """
    done = repaired.select(*keys, "left_start", "right_end").distinct()
    gone = plan.join(done.select(*(F.col(k).alias(f"_{k}") for k in keys), "left_start", "right_end"), [*(F.col(k) == F.col(f"_{k}") for k in keys), F.col("start_id").between(F.col("left_start"), F.col("right_end"))], "left_anti")
    return gone.unionByName(repaired.join(specs.select(*keys, "left_start", "right_end").distinct(), [*keys, "left_start", "right_end"], "left_semi").select(*plan.columns))


def pack_phrases(cues: DataFrame, most: int, bypass: Sequence[str] = (), keys: Sequence[str] = ("job",), order: str = "cue_id") -> DataFrame:
    """Windows of whole phrases with at most `most` cues; bypassed kinds part windows and have none.

    A phrase longer than that is a window of its own. A timeline is one ordered fold over its phrases.
    """
    over = Window.partitionBy(*keys).orderBy(order)
    marked = candidate_boundaries(cues, keys=keys, order=order).withColumn("_skip", F.col("kind").isin(*bypass) if bypass else F.lit(False))
    fresh = F.coalesce(F.lag("boundary").over(over), F.lit(True)) | F.col("_skip") | F.coalesce(F.lag("_skip").over(over), F.lit(False))
    marked = marked.withColumn("_phrase", F.sum(fresh.cast("int")).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    phrases = marked.groupBy(*keys, "_phrase").agg(F.count("*").alias("n"), F.max("_skip").alias("skip"), F.min(order).alias("first"), F.max(order).alias("last"))
    kinds = ", ".join(f"{k} {cues.schema[k].dataType.simpleString()}" for k in keys)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        rows: list[list] = []
        count, open_window = 0, False
        for p in pdf.sort_values("_phrase").itertuples():
            if p.skip:
                open_window = False
                continue
            if not open_window or count + p.n > most:
                rows.append([*(pdf[k].iloc[0] for k in keys), int(p.first), int(p.last)])
                count, open_window = 0, True
            rows[-1][-1] = int(p.last)
            count += p.n
        return pd.DataFrame(rows, columns=[*keys, "start_id", "end_id"])

    return fold_groups(phrases, keys, fold, f"{kinds}, start_id long, end_id long")


#: Marks that end a sentence, and marks inside one (fixed values).
STRONG, WEAK = "。！？!?：:", "、,，"


def _letters(text: str) -> str:
    """Without white space and punctuation."""
    return "".join(c for c in text if not c.isspace() and unicodedata.category(c)[0] != "P")


def projected_marks(units: list[str], text: str, ratio: float = 0.6, block: int = 4) -> list[str | None]:
    """'strong' or 'weak' for the unit in which a place ends that an alike text marks, strictly inside a block of equal letters."""
    found: list[str | None] = [None] * len(units)
    ends = np.cumsum([len(_letters(u)) for u in units])
    plain, joined = _letters(text), _letters("".join(units))
    matcher = SequenceMatcher(None, plain, joined, autojunk=False)
    if not plain or not joined or matcher.ratio() < ratio:
        return found
    blocks = [b for b in matcher.get_matching_blocks() if b.size >= block]
    begins = [b.a for b in blocks]
    # a mark stands after so many letters of the text
    marks = [(len(_letters(text[:at])), c in STRONG) for at, c in enumerate(text) if c in STRONG or c in WEAK]
    for place, strong in marks:
        near = bisect_left(begins, place) - 1
        if near < 0 or place >= begins[near] + blocks[near].size:
            continue
        unit = int(np.searchsorted(ends, blocks[near].b + place - begins[near]))
        if unit < len(units) and (strong or found[unit] is None):
            found[unit] = "strong" if strong else "weak"
    return found


def project_punctuation(units: DataFrame, texts: DataFrame, keys: Sequence[str] = ("job", "rec_ix"), order: str = "cue_id") -> DataFrame:
    """Adds boundary_hint to units from the punctuated text of their record; one record is one group."""
    met = units.join(texts.select(*keys, F.col("text").alias("_whole")), list(keys), "left")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in units.schema), "boundary_hint string"])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        hints = projected_marks(pdf.text.tolist(), pdf._whole.iloc[0] or "")
        return pdf.drop(columns="_whole").assign(boundary_hint=pd.Series(hints, index=pdf.index, dtype=object))

    return fold_groups(met, keys, fold, schema)


def status_gate(df: DataFrame, pending: Column) -> DataFrame:
    """The table, or an error when it is read while a row is pending."""
    count = df.agg(F.count_if(pending).alias("_pending"))
    checked = count.select(F.assert_true(F.col("_pending") == 0, F.concat(F.col("_pending").cast("string"), F.lit(" results are pending"))).alias("_ok"))
    return df.join(F.broadcast(checked), F.col("_ok").isNull()).drop("_ok")
