"""Keyed results: checks, reconciliation, signatures and what is left to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def coverage_errors(records: DataFrame, bounds: DataFrame, keys: Sequence[str] = ("job",)) -> DataFrame:
    """Records (start_id, end_id) that do not continue the one before, and groups not covered to their end.

    bounds: first_id, last_id. One row an error: at, expected, found.
    """
    over = Window.partitionBy(*keys).orderBy("start_id", "end_id")
    met = records.join(bounds, list(keys))
    expected = F.coalesce(F.lag("end_id").over(over) + 1, "first_id")
    steps = met.select(*keys, expected.alias("expected"), F.col("start_id").alias("found"), (F.col("start_id") != expected).alias("bad"), F.lit("start").alias("at"))
    ends = met.groupBy(*keys).agg(F.max("end_id").alias("found"), F.max("last_id").alias("expected")).select(*keys, "expected", "found", (F.col("expected") != F.col("found")).alias("bad"), F.lit("end").alias("at"))
    none = bounds.join(records, list(keys), "left_anti").select(*keys, F.col("first_id").alias("expected"), F.lit(None).cast("long").alias("found"), F.lit(True).alias("bad"), F.lit("start").alias("at"))
    return steps.unionByName(ends).unionByName(none).where("bad").drop("bad")


def reconcile(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Keys that are missing, unexpected or duplicate, one row each."""
    counts = found.groupBy(key).agg(F.count("*").alias("n"))
    wanted = expected.select(key).distinct()
    rows = [
        wanted.join(counts, key, "left_anti").select(key, F.lit("missing").alias("issue")),
        counts.join(wanted, key, "left_anti").select(key, F.lit("unexpected").alias("issue")),
        counts.where("n > 1").select(key, F.lit("duplicate").alias("issue")),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def accept(expected: DataFrame, responses: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Each expected key with its reasons for rejection: 'missing', or the rules that its response breaks."""
    met = expected.join(responses.withColumn("_there", F.lit(True)), key, "left")
    reasons = F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules.items())))
    return met.withColumn("reasons", F.when(F.col("_there").isNull(), F.array(F.lit("missing"))).otherwise(reasons)).drop("_there")


def missing_only(expected: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What has no stored result yet."""
    return expected.join(done.select(*keys).distinct(), list(keys), "left_anti")


def current(state: DataFrame, signatures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored results made under the current signature; all others count as missing."""
    return state.join(signatures, [*keys, "signature"], "left_semi")


def upsert_last(state: DataFrame, fresh: DataFrame, keys: Sequence[str], order: str, most: int = 400) -> DataFrame:
    """Old and new rows of one model, the last `most` of each key; rows of an earlier model go."""
    model = fresh.select(*keys, F.col("model").alias("_model")).distinct()
    kept = state.join(model, list(keys), "left").where("_model is null or model = _model").drop("_model")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return kept.unionByName(fresh).withColumn("_n", rank).where(F.col("_n") <= most).drop("_n")


def failure_class(status: Column, message: Column) -> Column:
    """'transient', 'fatal' or 'content' for an attempt log."""
    return F.when(status.isin(408, 409, 425, 429) | status.between(500, 599) | (status.isNull() & message.rlike("(?i)timeout|connection")), "transient").when(status.isNotNull() & (status >= 400), "fatal").otherwise("content")


def response_code(message: Column) -> Column:
    """412 before 429 before 406, from 'code: N', 'code=N' or 'HTTP N'."""
    found = lambda n: message.rlike(rf"(?i)(?:code[\"']?\s*[:=]\s*{n}\b|HTTP\s*{n}\b)")
    return F.when(found(412), 412).when(found(429), 429).when(found(406), 406)


def backoff_ms(attempt: Column, seed: int = 0) -> Column:
    """2 ** (attempt - 1) seconds, spread by a quarter."""
    return F.floor(1000 * F.pow(F.lit(2.0), attempt - 1) * (0.75 + 0.5 * F.rand(seed))).cast("long")


def token_budget(seconds: Column, most: int) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(128), F.ceil(32 * seconds) + 32))


def distinct_limited(tokens: DataFrame, keys: Sequence[str], column: str, order: str, limit: int, longest: int = 20) -> DataFrame:
    """First spelling of each token, whatever its case, in order, at most `limit` a group."""
    plain = F.trim(F.regexp_replace(F.ltrim(F.col(column)), "^#+", ""))
    rows = tokens.select(*keys, F.col(order), F.left(F.replace(plain, F.lit(","), F.lit(" ")), F.lit(longest)).alias("tag")).where("tag <> ''")
    first = F.row_number().over(Window.partitionBy(*keys, F.lower("tag")).orderBy(order))
    unique = rows.withColumn("_n", first).where("_n = 1").drop("_n")
    return unique.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where(F.col("place") <= limit)


def normalise_url(url: Column) -> Column:
    """Escaped marks of a pasted address as they are meant."""
    return F.regexp_replace(F.trim(url), r"\\([?=&])", "$1")


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(normalise_url(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
