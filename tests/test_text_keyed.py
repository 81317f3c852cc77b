from __future__ import annotations

import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.functions import text as tx
from tempora.functions import time as tm
from tempora.operators import adapters, joins, keyed, vectors
from tempora.operators import aggregates as ag
from tempora.sources import settings, subtitles


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_display_width_matches_unicode_tables(spark):
    text = "aあ　b é́ ｗ\t漢字!"

    def width(c):
        return 35 if c.isspace() else 0 if unicodedata.combining(c) else 100 if unicodedata.east_asian_width(c) in "WF" else 55

    assert one(spark, tx.display_width(F.col("t")), t=text) == sum(map(width, text))


def test_repetition_loops(spark):
    phrase = "あいうえおかきくけこさしすせそたちつてとな"
    df = spark.createDataFrame([(phrase * 10,), ("the same words the same words",)], "t string").select(tx.repetition_loops(F.col("t")).alias("loop"))
    rows = df.select("loop", tx.loop_phrase(F.col("loop")).alias("p")).collect()
    assert rows[0]["p"] == phrase and len(rows[0]["loop"]) // len(phrase) >= 4 and rows[1]["loop"] is None


def test_text_overlap(spark):
    assert one(spark, tx.without_overlap(F.col("a"), F.col("b")), a="君とここで歌う", b="ここで歌う明日へ") == "明日へ"
    assert one(spark, tx.without_overlap(F.col("a"), F.col("b")), a="ab", b="abc") == "abc"


@pytest.mark.parametrize(("a", "b", "joined"), [("so-", "called", "socalled"), ("dash--", "x", "dash-- x"), ("漢字", "かな", "漢字かな"), ("漢字", "x", "漢字 x"), ("", "x", "x")])
def test_join_fragments(spark, a, b, joined):
    assert one(spark, tx.join_fragments(F.col("a"), F.col("b")), a=a, b=b) == joined


def test_markers(spark):
    df = spark.createDataFrame([("[音楽]",), ("a [Background  Music] b\n[笑]\n c",), ("[Aメロ] x",)], "t string")
    assert [r[0] for r in df.select(tx.without_markers(F.col("t"))).collect()] == ["", "a b\nc", "[Aメロ] x"]


def test_truncated_utf16(spark):
    assert one(spark, tx.truncated_utf16(F.col("t"), 2000), t="a" * 1999 + "🎶" + "tail") == "a" * 1999
    assert one(spark, tx.utf16_units(F.col("t")), t="🎶") == 2


@pytest.mark.parametrize("seconds", [1.234, 3.456, 65.0, 66.001])
def test_srt_time_round_trip(spark, seconds):
    us = round(seconds * 1_000_000)
    assert one(spark, tm.from_srt_time(tm.srt_time(F.col("t"))), t=us) == us


def test_retry_after(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert one(spark, tm.retry_after(F.col("t"), now), t="1.2") == 2
    assert one(spark, tm.retry_after(F.col("t"), now), t="Mon, 01 Jan 2024 00:00:30 GMT") == 30
    assert one(spark, tm.retry_after(F.col("t"), now), t="Sun, 31 Dec 2023 00:00:30 GMT") == 0


def test_subtitles_round_trip(spark, tmp_path):
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.500\n<c>hello</c>\n\nNOTE x\n\n1\n00:00:03,000 --> 00:00:04,000\ntwo\nlines\n\n00:00:05.000 --> 00:00:06.000\n<i></i>\n"
    files = spark.createDataFrame([(1, vtt)], "job long, text string")
    found = subtitles.parse_subtitles(files)
    assert [tuple(r) for r in found.orderBy("cue_id").collect()] == [(1, 0, 1_000_000, 2_500_000, "hello"), (1, 1, 3_000_000, 4_000_000, "two\nlines")]
    again = subtitles.parse_subtitles(subtitles.srt_blocks(found))
    assert again.exceptAll(found).count() == 0


def test_sidecar_version_is_checked(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 0, 5, "a", None, "speech", None)], "job long, cue_id long, start_us long, end_us long, text string, speaker string, kind string, boundary_hint string")
    subtitles.write_sidecar(rows, str(tmp_path / "s"))
    assert subtitles.read_sidecar(spark, str(tmp_path / "s")).count() == 1
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.json").write_text('{"version": 2, "cues": []}')
    with pytest.raises(Exception, match="unsupported version"):
        subtitles.read_sidecar(spark, str(tmp_path / "bad")).collect()


def test_state_is_a_miss_when_absent(spark, tmp_path):
    assert subtitles.read_state(spark, str(tmp_path / "none"), "job long, x int").count() == 0


def test_settings():
    assert settings.from_toml("window_units = 10").window_units == 10
    for bad in ("other = 1", "window_units = 0", "match_margin = 'x'", "target_window_seconds = 100.0"):
        with pytest.raises(ValueError):
            settings.from_toml(bad)


def test_reconcile(spark):
    found = spark.createDataFrame([(0,), (0,), (2,)], "id long")
    got = sorted(tuple(r) for r in keyed.reconcile(found, spark.createDataFrame([(0,), (1,)], "id long"), "id").collect())
    assert got == [(0, "duplicate"), (1, "missing"), (2, "unexpected")]


def test_coverage_errors(spark):
    rec = spark.createDataFrame([(1, 0, 0), (1, 2, 2)], "job long, start_id long, end_id long")
    got = keyed.coverage_errors(rec, spark.createDataFrame([(1, 0, 2)], "job long, first_id long, last_id long")).collect()
    assert [(r["at"], r["expected"], r["found"]) for r in got] == [("start", 1, 2)]


def test_majority(spark):
    df = spark.createDataFrame([(1, "r"), (1, None), (1, "y"), (1, "r"), (2, "r"), (2, "y"), (3, None)], "g long, v string")
    assert {r["g"]: r["winner"] for r in ag.majority(df, ("g",), "v").collect()} == {1: "r", 2: None, 3: None}


def test_alias_goes_to_the_hottest(spark):
    tokens = spark.createDataFrame([("X",), ("none",)], "t string")
    catalog = spark.createDataFrame([("cold", 20, 0, ["x"]), ("hot", 100, 1, ["x"])], "canonical string, heat int, ord int, aliases array<string>")
    assert sorted((r["canonical"], r["heat"]) for r in joins.resolve_alias(tokens, catalog, "t").collect()) == [("hot", 100), ("none", 0)]


def test_later_file_overrides(spark):
    df = spark.createDataFrame([("a", "old", 0), ("a", "new", 1), ("b", "x", 0)], "k string, v string, load int")
    assert {tuple(r) for r in joins.override(df, ("k",), "v", "load").collect()} == {("a", "new"), ("b", "x")}


def test_tags(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(["#a", "a", "b, C D", ""])], "g long, i long, t string")
    got = [r["tag"] for r in keyed.distinct_limited(df, ("g",), "t", "i", 3).orderBy("i").collect()]
    assert got == ["a", "b  C D"]


@pytest.mark.parametrize(("n", "k", "expected"), [(10, 4, [0, 3, 6, 9]), (3, 4, [0, 1, 2]), (5, 1, [2])])
def test_evenly_spaced(spark, n, k, expected):
    df = spark.createDataFrame([(1, i) for i in range(n)], "g long, i long")
    assert [r["i"] for r in vectors.evenly_spaced(df, k, ("g",), "i").orderBy("i").collect()] == expected


def test_spherical_centers():
    two = np.array([[1.0, 0.0]] * 4 + [[0.0, 1.0]] * 4)
    assert len(vectors.spherical_centers(two, 3, 3)) == 2
    assert len(vectors.spherical_centers(np.array([[1.0, 0.0]] * 9 + [[0.0, 1.0]]), 2, 3)) == 1


def test_trimmed_distance_ignores_the_outlier(spark):
    rows = [("A", i, [1.0, 0.0], 1.0) for i in range(9)] + [("A", 9, [0.0, 1.0], 10.0)]
    df = spark.createDataFrame(rows, "label string, seq long, embedding array<float>, duration double")
    assert vectors.trimmed_distances(df, {"p": np.array([1.0, 0.0])}, ("label",)).first()["distance"] == pytest.approx(0)


def test_margin_gate(spark):
    def at(angle):
        return [float(np.cos(angle)), float(np.sin(angle))]

    df = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<float>")

    def sure(a, b):
        centers = spark.createDataFrame([("x", at(np.arccos(1 - a))), ("y", at(np.arccos(1 - b)))], "character string, center array<double>")
        return vectors.nearest_profile(df, centers, "id", 0.32, 0.03).first()["sure"]

    assert not sure(0.258, 0.261) and sure(0.143, 0.304)


def test_leader_clusters(spark):
    rows = [(1, "hello world again", 0.5, 0, 0), (1, "hello world agaim", 0.9, 1, 10), (1, "other", 0.9, 2, 20)]
    df = spark.createDataFrame(rows, "job long, text string, score double, frame_ix long, ts_us long")
    got = ag.leader_clusters(df, ("job",), 2).collect()
    assert [(r["text"], r["frames"], r["first_us"], r["last_us"]) for r in got] == [("hello world agaim", 2, 0, 10)]


def test_retry_halving(spark):
    units = spark.createDataFrame([(1, 0, 7)], "job long, start_id long, end_id long")

    def compute(df):
        return df.withColumn("ok", (F.col("start_id") > 3) | (F.col("end_id") - F.col("start_id") < 2))

    got = adapters.retry_halving(units, compute, "ok", 1, lambda df: df)
    assert sorted((r["start_id"], r["end_id"]) for r in got.collect()) == [(0, 1), (2, 3), (4, 7)]


def test_resume_computes_only_the_missing(spark):
    state = spark.createDataFrame([(1, "old")], "id long, v string")
    got = adapters.resume(spark.createDataFrame([(1,), (2,)], "id long"), state, ("id",), lambda df: df.withColumn("v", F.lit("new")))
    assert {tuple(r) for r in got.collect()} == {(1, "old"), (2, "new")}


def test_upsert_drops_an_earlier_model(spark):
    schema = "c string, seq long, model string"
    old = spark.createDataFrame([("a", 0, "m1"), ("b", 0, "m1")], schema)
    new = spark.createDataFrame([("a", i, "m2") for i in range(1, 5)], schema)
    got = sorted(tuple(r) for r in keyed.upsert_last(old, new, ("c",), "seq", 3).collect())
    assert got == [("a", 2, "m2"), ("a", 3, "m2"), ("a", 4, "m2"), ("b", 0, "m1")]
