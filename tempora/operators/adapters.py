"""Tables in, tables out: models, services and workers outside Spark.

An adapter is a function from batches of rows to batches of rows, called once a
partition, so a model loads once a task. Tests plug in deterministic functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Adapter = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def apply_adapter(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """load makes the model once a task; what it returns maps one batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(run, schema)


def resume(expected: DataFrame, state: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stored results and those of the missing keys, computed now."""
    missing = expected.join(state.select(*keys).distinct(), list(keys), "left_anti")
    return state.unionByName(compute(missing))


def retry_halving(units: DataFrame, compute: Callable[[DataFrame], DataFrame], valid: str, floor: int, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Computes ranges (job, start_id, end_id); those whose result breaks `valid` are halved and tried again.

    Ranges of at most `floor` units keep their result. Every level is one pass
    over the ranges that are left; `store` writes a level, so a restart resumes.
    """
    done, level = None, units
    while True:
        results = store(compute(level))
        last = (F.col("end_id") - F.col("start_id") + 1) <= floor
        good = results.where(F.expr(valid) | last)
        done = good if done is None else done.unionByName(good)
        bad = results.where(~(F.coalesce(F.expr(valid), F.lit(False)) | last)).select("job", "start_id", "end_id")
        if not bad.limit(1).count():
            return done
        middle = F.floor((F.col("start_id") + F.col("end_id")) / 2)
        level = bad.select("job", F.explode(F.array(F.struct(F.col("start_id"), middle.alias("end_id")), F.struct((middle + 1).alias("start_id"), F.col("end_id")))).alias("x")).select("job", "x.*")


def choose_route(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of two results of each key the healthy first, else the healthy second; 'route' is null without any."""
    a = first.select(*keys, F.col("healthy").alias("a_ok"), F.col("text").alias("a_text"))
    b = second.select(*keys, F.col("healthy").alias("b_ok"), F.col("text").alias("b_text"))
    met = a.join(b, list(keys), "full_outer")
    route = F.when(F.coalesce("a_ok", F.lit(False)), "first").when(F.coalesce("b_ok", F.lit(False)), "second")
    return met.select(*keys, route.alias("route"), F.when(route == "first", F.col("a_text")).when(route == "second", F.col("b_text")).alias("text"))
