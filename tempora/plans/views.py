"""Base tables of the queries: the driver's tables as timelines, cues and vectors.

The SQL twins use the CTEs of the same names in SQL_VIEWS.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timeline a user: each event lasts as many minutes as its value."""
    events = table(spark, sf_dir, "events")
    s = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.select(F.col("user_id").alias("job"), F.col("event_id").alias("rid"), F.col("event_type").alias("label"), s.alias("s"), F.round(F.col("value") * 60_000_000).cast("long").alias("_d"))
    return rows.withColumn("e", F.col("s") + F.col("_d")).drop("_d")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timeline a conversation: a turn every five seconds, as long as its text."""
    rows = table(spark, sf_dir, "conversations")
    s = F.col("turn").cast("long") * 5_000_000
    return rows.select(F.col("conv_id").alias("job"), F.col("turn").cast("long").alias("cue_id"), F.when(F.col("role") != "system", F.col("role")).alias("speaker"), "text", F.col("role").alias("kind"), s.alias("s"), (s + F.greatest(F.lit(500_000), F.length("text") * 50_000)).alias("e"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


SQL_VIEWS = {
    "regions": "regions AS (SELECT user_id AS job, event_id AS rid, event_type AS label, epoch_us(ts) AS s, epoch_us(ts) + CAST(round(value * 60000000) AS BIGINT) AS e FROM events)",
    "cues": "cues AS (SELECT conv_id AS job, CAST(turn AS BIGINT) AS cue_id, CASE WHEN role <> 'system' THEN role END AS speaker, text, role AS kind, CAST(turn AS BIGINT) * 5000000 AS s, CAST(turn AS BIGINT) * 5000000 + greatest(500000, length(text) * 50000) AS e FROM conversations)",
}


def sql(body: str, *views: str, **ctes: str) -> str:
    """A statement over views, then further CTEs in order."""
    parts = [SQL_VIEWS[v] for v in views] + [f"{name} AS ({text})" for name, text in ctes.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
