"""Named queries over the driver tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tempora.plans import records, texts, timelines


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**timelines.Q, **texts.Q, **records.Q}


def oracle_sql() -> dict[str, str]:
    return {**timelines.SQL, **texts.SQL, **records.SQL}
