from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tempora.functions import documents as dc
from tempora.operators import records as rc

S = 1_000_000


@pytest.mark.parametrize(
    ("text", "found"),
    [('```json\n[{"id": 1}]\n```', [{"id": 1}]), ('{"cues": [1, 2]}', [1, 2]), ('{"a": 1}, {"a": 2}', [{"a": 1}, {"a": 2}]), ('{"a": 1}\n{"a": 2}', [{"a": 1}, {"a": 2}]), ("no", None), ("", None), (None, None)],
)
def test_loose_records(text, found):
    assert dc.loose_records(text) == found


def test_flat_lines(spark):
    df = spark.createDataFrame([('{"a": {"b": 1, "c": ["x", "y"]}, "d": [{"e": ""}, {"e": 2}]}',)], "t string")
    assert df.select(dc.json_lines("t")).first()[0] == ["a.b:1", "a.c:x｜y", "d[0].e:", "d[1].e:2"]
    assert dc.flat_lines({"x": None, "y": [True, " a  b "], "z": False, "w": []}) == ["x:", "y:true｜a b", "z:false", "w:"]
    assert dc.flat_lines([{"k": 1}, 2]) == ["[0].k:1", "[1]:2"]


def test_normalised(spark):
    assert spark.createDataFrame([("Ａ　 b",), (None,)], "t string").select(dc.normalised("t")).collect() == [("A b",), (None,)]


def test_two_lines_split_at_the_mark():
    assert dc.two_lines("漢漢漢漢漢漢，漢漢漢漢漢漢", 1000) == "漢漢漢漢漢漢\n漢漢漢漢漢漢"
    assert dc.two_lines("漢" * 30, 1000) is None


def test_metadata(spark):
    df = spark.createDataFrame([({"channel": "c", "other": "x", "tags": "[]", "album": ""},)], "m map<string,string>")
    assert df.select(dc.kept_metadata(F.col("m"))).first()[0] == {"channel": "c"}


def test_health(spark):
    cue = "struct<start_us:long,end_us:long,text:string,speaker:string,kind:string>"
    good = [(i * S, (i + 1) * S, "word", None, "speech") for i in range(5)]
    rows = [
        (1, 0, 0, 10 * S, "some words that go on and on here", good, None), (1, 1, 0, 10 * S, "あいうえおかきくけこさしすせそたちつてとな" * 10, good, None), (1, 2, 0, 10 * S, "x", [(5, 5, "x", None, "speech")], None),
        (1, 3, 0, 10 * S, "", [], True), (1, 4, 0, 10 * S, "many words begin at one moment only", [(0, S, "w", None, "speech")] * 20, None), (1, 5, 0, 100 * S, "a long text of one short moment", [(0, 1000, "w", None, "speech")], None),
    ]
    df = spark.createDataFrame(rows, f"job long, rec_ix long, core_start_us long, core_end_us long, text string, cues array<{cue}>, skipped_empty boolean")
    assert [r["healthy"] for r in rc.healthy_records(df).orderBy("rec_ix").collect()] == [True, False, False, True, False, False]


def test_dense(spark):
    schema = "job long, rid long, label string, s long, e long"
    windows = spark.createDataFrame([(1, 0, "w", 0, 60 * S), (1, 1, "w", 100 * S, 160 * S)], schema)
    spans = spark.createDataFrame([(1, 0, "x", 0, 30 * S), (1, 1, "x", 40 * S, 60 * S), (1, 2, "x", 100 * S, 142 * S)], schema)
    assert [r["rid"] for r in rc.dense(windows, spans).collect()] == [0]
    # two pauses of 10 s are 20 s of silence
    twice = spark.createDataFrame([(1, 0, "x", 0, 20 * S), (1, 1, "x", 30 * S, 50 * S)], schema)
    assert rc.dense(windows.where("rid = 0"), twice).count() == 0


def test_boundaries_and_splice(spark):
    plan = spark.createDataFrame([(1, 0, 1), (1, 2, 3), (1, 4, 5)], "job long, start_id long, end_id long")
    windows = spark.createDataFrame([(1, 0, 3), (1, 4, 5)], "job long, start_id long, end_id long")
    specs = rc.boundary_specs(plan, windows)
    assert [tuple(r) for r in specs.collect()] == [(1, 2, 3, 5)]
    fixed = spark.createDataFrame([(1, 2, 5, 2, 2), (1, 2, 5, 3, 5)], "job long, left_start long, right_end long, start_id long, end_id long")
    assert sorted(tuple(r) for r in rc.splice(plan, specs, fixed).collect()) == [(1, 0, 1), (1, 2, 2), (1, 3, 5)]


def test_pack_phrases(spark):
    kinds = ["speech", "speech", "singing", "conditioned_speech", "speech", "speech"]
    rows = [(1, i, None, "x", k, i * S, (i + 1) * S) for i, k in enumerate(kinds)]
    df = spark.createDataFrame(rows, "job long, cue_id long, speaker string, text string, kind string, s long, e long")
    assert sorted((r["start_id"], r["end_id"]) for r in rc.pack_phrases(df, 1, ("singing", "conditioned_speech")).collect()) == [(0, 1), (4, 5)]


def test_projected_marks(spark):
    assert rc.projected_marks(["hello there", "my friend", "bye"], "hello there, my friend! bye") == ["weak", "strong", None]
    assert rc.projected_marks(["hello there", "my friend", "bye"], "hello there. my friend: bye") == [None, "strong", None]
    assert rc.projected_marks(["it's hello", "there my", "friend"], "its hello, there! my friend") == ["weak", "strong", None]
    assert rc.projected_marks(["abc", "def"], "zzzz, yyyy") == [None, None]
    units = spark.createDataFrame([(1, 0, 0, "hello there"), (1, 0, 1, "my friend")], "job long, rec_ix long, cue_id long, text string")
    texts = spark.createDataFrame([(1, 0, "hello there! my friend")], "job long, rec_ix long, text string")
    assert [r["boundary_hint"] for r in rc.project_punctuation(units, texts).orderBy("cue_id").collect()] == ["strong", None]


def test_pending_results_block(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "pending")], "id long, status string")
    assert rc.status_gate(df.where("id = 1"), F.col("status") == "pending").count() == 1
    with pytest.raises(Exception, match="pending"):
        rc.status_gate(df, F.col("status") == "pending").collect()


def test_template():
    assert dc.template_filled("a {{x}}", ["x"], x="1") == "a 1"
    with pytest.raises(ValueError):
        dc.template_filled("a {{y}}", ["x"], x="1")
