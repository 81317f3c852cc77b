from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tempora.streaming import sessions as st

T0 = datetime(2024, 1, 1)


def stream(spark, tmp_path, rows, schema):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def finish(query):
    query.processAllAvailable()
    query.stop()


def test_sessions(spark, tmp_path):
    rows = [(1, T0 + timedelta(minutes=m)) for m in (0, 1, 20)] + [(2, T0), (9, T0 + timedelta(hours=5))]
    counts = st.session_counts(stream(spark, tmp_path, rows, "user_id long, ts timestamp"), "5 minutes", "1 minute")
    finish(counts.writeStream.outputMode("append").format("memory").queryName("sess").start())
    assert sorted((r["user_id"], r["n"]) for r in spark.table("sess").collect()) == [(1, 1), (1, 2), (2, 1)]


def test_hysteresis_closes_after_release(spark, tmp_path):
    base = int(T0.timestamp() * 1_000_000)
    rows = [("a", T0 + timedelta(seconds=s), base + s * 1_000_000, base + (s + 5) * 1_000_000, raw) for s, raw in ((0, 0.9), (5, 0.1), (10, 0.8), (60, 0.7))]
    df = stream(spark, tmp_path, rows, "job string, ts timestamp, s long, e long, raw double").withWatermark("ts", "1 second")
    out = st.hysteresis(df, 0.5, 20_000_000)
    finish(out.writeStream.outputMode("append").format("memory").queryName("hyst").start())
    got = [((r["s"] - base) // 1_000_000, (r["e"] - base) // 1_000_000, r["confidence"]) for r in spark.table("hyst").collect()]
    assert (0, 15, 0.9) in got


def test_compute_missing_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "state")
    spark.createDataFrame([(1, 1)], "id long, v int").write.parquet(path)
    run = st.compute_missing(["id"], lambda df: df.withColumn("v", F.lit(7)), lambda: spark.read.parquet(path), lambda df: df.write.mode("append").parquet(path))
    batch = spark.createDataFrame([(1,), (2,)], "id long")
    run(batch, 0)
    run(batch, 0)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 1), (2, 7)]
