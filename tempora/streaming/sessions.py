"""Structured Streaming: sessions, hysteresis, and results computed once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def session_counts(events: DataFrame, gap: str, delay: str, key: str = "user_id", time: str = "ts") -> DataFrame:
    """Sessions of each key that end after a pause of `gap`; rows later than `delay` are dropped."""
    return events.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("session")).agg(F.count("*").alias("n")).select(key, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")


def hysteresis(scores: DataFrame, threshold: float, release: int, key: str = "job", time: str = "ts") -> DataFrame:
    """Episodes of windows (key, ts, s, e, raw): opened at the threshold, closed `release` microseconds after the last one.

    State is one open episode a key; it is flushed by event time, so an episode
    ends when the watermark has passed its release.
    """
    kind = scores.schema[key].dataType.simpleString()

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        done: list[tuple] = []
        if state.hasTimedOut:
            done.append((*name, *state.get))
            state.remove()
        else:
            now: Any = state.get if state.exists else None
            for row in pd.concat(list(batches)).sort_values(["s", "e"]).itertuples():
                if row.raw < threshold:
                    continue
                if now is not None and row.s - now[1] > release:
                    done.append((*name, *now))
                    now = None
                now = (int(row.s), int(row.e), float(row.raw)) if now is None else (now[0], max(now[1], int(row.e)), max(now[2], float(row.raw)))
            if now is not None:
                state.update(now)
                state.setTimeoutTimestamp(max((now[1] + release) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(done, columns=[key, "s", "e", "confidence"])

    return scores.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, s long, e long, confidence double", "s long, e long, confidence double", "append", GroupStateTimeout.EventTimeTimeout)


def once_per_key(units: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key within the watermark."""
    return units.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def compute_missing(keys: list[str], compute: Callable[[DataFrame], DataFrame], read: Callable[[], DataFrame], write: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: computes and stores what has no result yet; a batch that comes again adds nothing."""

    def run(batch: DataFrame, _: int) -> None:
        write(compute(batch.join(read().select(*keys).distinct(), keys, "left_anti")))

    return run
