"""Roll-ups, votes and clusters."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def stage_rollup(stages: DataFrame) -> DataFrame:
    """Calls, failures and times of each stage; milliseconds keep sums exact."""
    return stages.groupBy("name").agg(
        F.count("*").alias("calls"), F.count_if(F.col("status") == "completed").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"), F.sum("elapsed_ms").alias("total_ms"), F.max("elapsed_ms").alias("longest_ms"), F.max("peak_mib").alias("peak_mib")
    )


def majority(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each group, null ones not counted; a tie gives null."""
    counts = df.groupBy(*keys, value).agg(F.count(value).alias("n"))
    most = F.max("n").over(Window.partitionBy(*keys))
    top = F.when((F.col("n") == most) & (F.col("n") > 0), F.col(value))
    return counts.withColumn("_top", top).groupBy(*keys).agg(F.when(F.count("_top") == 1, F.max("_top")).alias("winner"))


def uniform_or(df: DataFrame, keys: Sequence[str], value: str, other: str = "mixed") -> DataFrame:
    """The value all rows of a group share, else `other`; null is a value."""
    same = (F.count_distinct(value) == 1) & (F.count(value) == F.count("*"))
    return df.groupBy(*keys).agg(F.when(same, F.max(value)).when(F.count(value) == 0, F.lit(None)).otherwise(F.lit(other)).alias("value"))


def majority_share(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Rows of each group's most frequent value, and all its rows."""
    return df.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("most"), F.sum("n").alias("rows"))


def hit_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Token sums and cache hits; a missing miss count is prompt minus hit."""
    miss = F.coalesce("miss", F.col("prompt") - F.col("hit"))
    sums = df.groupBy(*keys).agg(F.sum("prompt").alias("prompt"), F.sum("completion").alias("completion"), F.sum("hit").alias("hit"), F.sum(miss).alias("miss"))
    return sums.withColumn("hit_ppm", F.floor(F.try_divide(1_000_000 * F.col("hit"), F.col("hit") + F.col("miss"))).cast("long"))


def family_scores(df: DataFrame, keys: Sequence[str], families: dict[str, Column]) -> DataFrame:
    """Sums of class scores by family for each window."""
    return df.groupBy(*keys).agg(*(F.sum(F.when(test, F.col("score")).otherwise(0)).alias(name) for name, test in families.items()))


def leader_clusters(observations: DataFrame, keys: Sequence[str], least_frames: int = 2, ratio: float = 0.86) -> DataFrame:
    """Texts joined to the first cluster whose first text is alike; those seen in enough frames.

    observations: text, score, frame_ix, ts_us, in the order of frame and text. The
    similarity is difflib's, which no expression states: a group is one frame.
    """
    kinds = ", ".join(f"{k} {observations.schema[k].dataType.simpleString()}" for k in keys)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["frame_ix", "ts_us", "text"], kind="stable")
        leaders: list[str] = []
        member = []
        for text in pdf.text:
            found = next((i for i, lead in enumerate(leaders) if SequenceMatcher(None, lead, text).ratio() >= ratio), None)
            if found is None:
                found = len(leaders)
                leaders.append(text)
            member.append(found)
        rows = []
        for _, own in pdf.assign(_c=member).groupby("_c", sort=True):
            if own.frame_ix.nunique() >= least_frames:
                best = max(zip(own.text.str.len(), own.score, own.text, strict=True), key=lambda x: x[:2])
                rows.append([*(own[k].iloc[0] for k in keys), best[2], float(own.score.mean()), int(own.frame_ix.nunique()), int(own.ts_us.min()), int(own.ts_us.max())])
        return pd.DataFrame(rows, columns=[*keys, "text", "score", "frames", "first_us", "last_us"])

    return observations.groupBy(*keys).applyInPandas(fold, f"{kinds}, text string, score double, frames long, first_us long, last_us long")


def quietest(samples: DataFrame, keys: Sequence[str], probe: int) -> DataFrame:
    """Begin of the probe of `probe` samples with the least energy; samples: ix, amp."""
    energy = samples.groupBy(*keys, F.floor(F.col("ix") / probe).alias("_p")).agg(F.avg(F.col("amp") * F.col("amp")).alias("energy"))
    return energy.groupBy(*keys).agg(F.min_by((F.col("_p") * probe).alias("at"), F.struct("energy", "_p")).alias("at"))


def audible(samples: DataFrame, keys: Sequence[str], least: int, peak: float = 1e-4, rms: float = 1e-5) -> DataFrame:
    """Tracks long and loud enough."""
    found = samples.groupBy(*keys).agg(F.count("*").alias("n"), F.max(F.abs("amp")).alias("peak"), F.sqrt(F.avg(F.col("amp") * F.col("amp"))).alias("rms"))
    return found.where((F.col("n") >= least) & (F.col("peak") >= peak) & (F.col("rms") >= rms))
