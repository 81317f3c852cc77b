"""Queries of records, sources, samples and evidence with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.functions import documents as dc
from tempora.functions import text as tx
from tempora.functions import time as tm
from tempora.operators import aggregates as ag
from tempora.operators import intervals as iv
from tempora.operators import joins, keyed, records
from tempora.plans.timelines import FRAGMENT_JOIN, FRAGMENTS, merged
from tempora.plans.views import cues, documents, regions, sql, table
from tempora.sources import subtitles

Q: dict = {}
SQL: dict[str, str] = {}
HOUR = iv.HOUR

Q["embeddable_regions"] = lambda s, d: records.embeddable(regions(s, d).withColumn("source_path", F.when(F.col("label") == "view", "sep")).withColumn("overlap", F.col("rid") % 3 == 0), 60_000_000, HOUR, 2 * HOUR).select("job", "rid")
SQL["embeddable_regions"] = sql(f"SELECT job, rid FROM regions WHERE e - s >= 60000000 AND e - s <= CASE WHEN label = 'view' THEN {2 * HOUR} ELSE {HOUR} END AND (label = 'view' OR rid % 3 <> 0)", "regions")

Q["dense_windows"] = lambda s, d: records.dense(regions(s, d).where("label = 'click'"), regions(s, d).where("label <> 'click'"), HOUR, 0.3).select("job", "rid")
SQL["dense_windows"] = sql(
    f"SELECT o.job, o.rid FROM own o LEFT JOIN (SELECT job, rid, max(e - s) AS pause, sum(e - s) AS free FROM ({FRAGMENTS.format(own='own', cuts='cuts', least=1)}) GROUP BY job, rid) f ON o.job = f.job AND o.rid = f.rid WHERE o.e > o.s AND coalesce(f.free, 0) <= {HOUR} AND (o.e - o.s) - coalesce(f.free, 0) >= 0.3 * (o.e - o.s)",
    "regions", own="SELECT * FROM regions WHERE label = 'click'", cuts=merged("(SELECT * FROM regions WHERE label <> 'click' AND e > s)"),
)


def _plan(s, d):
    return cues(s, d).groupBy("job", F.floor(F.col("cue_id") / 2).alias("_p")).agg(F.min("cue_id").alias("start_id"), F.max("cue_id").alias("end_id")).drop("_p")


def _plan_windows(s, d):
    return cues(s, d).groupBy("job", F.floor(F.col("cue_id") / 4).alias("_p")).agg(F.min("cue_id").alias("start_id"), F.max("cue_id").alias("end_id")).drop("_p")


Q["boundary_specs"] = lambda s, d: records.boundary_specs(_plan(s, d), _plan_windows(s, d))
SQL["boundary_specs"] = sql(
    "SELECT p.job, p.a AS left_start, p.b AS left_end, p.r AS right_end FROM (SELECT *, lead(b) OVER w AS r, lead(a) OVER w AS ra FROM (SELECT job, min(cue_id) AS a, max(cue_id) AS b FROM cues GROUP BY job, cue_id // 2) WINDOW w AS (PARTITION BY job ORDER BY a)) p JOIN (SELECT job, max(cue_id) AS b FROM cues GROUP BY job, cue_id // 4) x ON p.job = x.job AND p.b = x.b WHERE p.ra = p.b + 1",
    "cues",
)


def _spliced(s, d):
    specs = records.boundary_specs(_plan(s, d), _plan_windows(s, d))
    fixed = specs.select("job", "left_start", "right_end", F.explode(F.array(F.struct(F.col("left_start").alias("start_id"), F.col("left_start").alias("end_id")), F.struct((F.col("left_start") + 1).alias("start_id"), F.col("right_end").alias("end_id")))).alias("x"))
    return records.splice(_plan(s, d), specs, fixed.select("job", "left_start", "right_end", "x.*"))


Q["boundary_splice"] = _spliced
SQL["boundary_splice"] = sql(
    "SELECT job, start_id, end_id FROM p WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.job = p.job AND p.start_id BETWEEN sp.l AND sp.r) UNION ALL SELECT job, l, l FROM sp UNION ALL SELECT job, l + 1, r FROM sp",
    "cues", p="SELECT job, min(cue_id) AS start_id, max(cue_id) AS end_id FROM cues GROUP BY job, cue_id // 2",
    sp="SELECT q.job, q.start_id AS l, q.r FROM (SELECT *, lead(end_id) OVER w AS r, lead(start_id) OVER w AS ra FROM p WINDOW w AS (PARTITION BY job ORDER BY start_id)) q JOIN (SELECT job, max(cue_id) AS b FROM cues GROUP BY job, cue_id // 4) x ON q.job = x.job AND q.end_id = x.b WHERE q.ra = q.end_id + 1",
)

Q["pack_phrases"] = lambda s, d: records.pack_phrases(cues(s, d), 3, ("system",))

Q["frame_times"] = lambda s, d: subtitles.frame_times(regions(s, d).where("label = 'purchase' and e > s"), 600_000_000).select("job", "rid", "ts_us")
SQL["frame_times"] = sql("SELECT job, rid, unnest(range(s, e + 1, 600000000)) AS ts_us FROM regions WHERE label = 'purchase' AND e > s", "regions")



def _follow(s, d):
    return cues(s, d).withColumn("before", F.lag("text").over(Window.partitionBy("job").orderBy("cue_id"))).where("before is not null")


Q["join_fragments"] = lambda s, d: _follow(s, d).select("job", "cue_id", tx.join_fragments(F.col("before"), F.col("text")).alias("joined"))
SQL["join_fragments"] = sql(
    rf"SELECT job, cue_id, {FRAGMENT_JOIN} AS joined FROM (SELECT job, cue_id, trim(regexp_replace(lag(text) OVER (PARTITION BY job ORDER BY cue_id), '\s+', ' ', 'g')) AS a, trim(regexp_replace(text, '\s+', ' ', 'g')) AS b FROM cues) WHERE a IS NOT NULL".replace("\\\\", "\\"),
    "cues",
)


def _samples(s, d):
    return table(s, d, "events").select("user_id", F.col("event_id").alias("ix"), (F.floor(F.col("value") * 100) % 64).cast("double").alias("amp"))


Q["quiet_probe"] = lambda s, d: ag.quietest(_samples(s, d), ("user_id",), 500)
SQL["quiet_probe"] = "SELECT user_id, arg_min(p * 500, (energy, p)) AS at FROM (SELECT user_id, event_id // 500 AS p, avg(a * a) AS energy FROM (SELECT user_id, event_id, CAST(floor(value * 100) % 64 AS DOUBLE) AS a FROM events) GROUP BY ALL) GROUP BY user_id"

Q["audible_tracks"] = lambda s, d: ag.audible(_samples(s, d), ("user_id",), 60, 63.0, 36.0).select("user_id", "n", "peak", F.round("rms", 6).alias("rms"))
SQL["audible_tracks"] = "SELECT user_id, count(*) AS n, max(abs(a)) AS peak, round(sqrt(avg(a * a)), 6) AS rms FROM (SELECT user_id, CAST(floor(value * 100) % 64 AS DOUBLE) AS a FROM events) GROUP BY user_id HAVING count(*) >= 60 AND max(abs(a)) >= 63 AND sqrt(avg(a * a)) >= 36"

Q["evidence_before"] = lambda s, d: joins.latest_before(regions(s, d).where("label = 'purchase'").select("job", "rid", "s"), regions(s, d).where("label <> 'purchase'"), ("job",), 5, -12 * HOUR, HOUR).select("job", "rid", F.explode("evidence").alias("x")).select("job", "rid", "x.r_e", "x.r_rid")
SQL["evidence_before"] = sql(
    f"SELECT job, rid, r_e, r_rid FROM (SELECT a.job, a.rid, b.e AS r_e, b.rid AS r_rid, row_number() OVER (PARTITION BY a.job, a.rid ORDER BY b.e DESC, b.rid DESC) AS n FROM regions a JOIN regions b ON a.job = b.job AND b.e BETWEEN a.s - {12 * HOUR} AND a.s + {HOUR} WHERE a.label = 'purchase' AND b.label <> 'purchase') WHERE n <= 5",
    "regions",
)


def _arrays(s, d):
    base = cues(s, d)
    speakers = base.groupBy("job").agg(F.array_sort(F.collect_set("speaker")).alias("speakers"))
    mapping = base.select("job", F.col("speaker").alias("anonymous"), F.concat("speaker", F.lit("#"), F.col("cue_id").cast("string")).alias("resolved"), F.col("cue_id").alias("seq")).where("anonymous = 'user'")
    return joins.resolve_array(speakers, mapping, "speakers").select("job", F.array_join("speakers", ",").alias("speakers"))


Q["identity_array_resolve"] = _arrays
SQL["identity_array_resolve"] = sql("SELECT job, string_agg(CASE WHEN speaker = 'user' THEN 'user#' || m ELSE speaker END, ',' ORDER BY speaker) AS speakers FROM (SELECT job, speaker, max(cue_id) AS m FROM cues WHERE speaker IS NOT NULL GROUP BY job, speaker) GROUP BY job", "cues")

Q["last_load_wins"] = lambda s, d: joins.override(documents(s, d).select("lang", "source", F.col("doc_id").alias("value"), "doc_id"), ("lang", "source"), "value", "doc_id")
SQL["last_load_wins"] = "SELECT lang, source, max(doc_id) AS value FROM documents GROUP BY lang, source"

Q["token_budgets"] = lambda s, d: table(s, d, "events").select("event_id", keyed.token_budget(F.col("value"), 4096).cast("long").alias("budget"))
SQL["token_budgets"] = "SELECT event_id, CAST(least(4096, greatest(128, ceil(32 * value) + 32)) AS BIGINT) AS budget FROM events"

Q["retry_waits"] = lambda s, d: table(s, d, "events").select("event_id", tm.retry_after(F.when(F.col("event_id") % 2 == 0, F.concat((F.col("event_id") % 90).cast("string"), F.lit(".5"))).otherwise("Mon, 01 Jan 2024 00:01:30 GMT"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("wait"))
SQL["retry_waits"] = "SELECT event_id, CAST(CASE WHEN event_id % 2 = 0 THEN event_id % 90 + 1 ELSE 90 END AS BIGINT) AS wait FROM events"

Q["srt_times"] = lambda s, d: cues(s, d).select("job", "cue_id", tm.from_srt_time(tm.srt_time(F.col("e"))).alias("us"))
SQL["srt_times"] = sql("SELECT job, cue_id, (e + 500) // 1000 * 1000 AS us FROM cues", "cues")

Q["subtitle_round_trip"] = lambda s, d: subtitles.parse_subtitles(subtitles.srt_blocks(cues(s, d).select("job", "cue_id", F.col("s").alias("start_us"), F.col("e").alias("end_us"), "text")))
SQL["subtitle_round_trip"] = sql("SELECT job, row_number() OVER (PARTITION BY job ORDER BY s, e, cue_id) - 1 AS cue_id, s // 1000 * 1000 AS start_us, (e + 500) // 1000 * 1000 AS end_us, trim(text) AS text FROM cues", "cues")

Q["routed_regions"] = lambda s, d: regions(s, d).where("label = 'view'").select("job", "rid", F.lit("speech").alias("route")).unionByName(regions(s, d).where("label = 'click'").select("job", "rid", F.lit("singing").alias("route"))).join(regions(s, d).where("label <> 'error' and e > s").select("job").distinct(), "job", "left_semi")
SQL["routed_regions"] = sql("SELECT job, rid, CASE label WHEN 'view' THEN 'speech' ELSE 'singing' END AS route FROM regions WHERE label IN ('view', 'click') AND job IN (SELECT job FROM regions WHERE label <> 'error' AND e > s)", "regions")

_SOUNDS = ("Music", "rock music", "Speech", "dog bark", "bell (Musical) box", "female SINGING", "musically", "narration, monologue")
Q["activity_labels"] = lambda s, d: table(s, d, "part").withColumn("name", F.lower(F.get(F.array(*map(F.lit, _SOUNDS)), (F.col("p_partkey") % len(_SOUNDS)).cast("int")))).select("p_partkey", "name", (tx.is_music(F.col("name")) | F.col("name").isin(*tx.SINGING_LABELS, *tx.SPEECH_LABELS)).alias("sound"))
SQL["activity_labels"] = f"SELECT p_partkey, name, name IN ('music', 'rock music', 'speech', 'bell (musical) box', 'female singing', 'narration, monologue') AS sound FROM (SELECT p_partkey, lower(list_extract({list(_SOUNDS)}, CAST(p_partkey % {len(_SOUNDS)} AS INT) + 1)) AS name FROM part)"

Q["props_lines"] = lambda s, d: table(s, d, "events").select("event_id", F.array_join(dc.json_lines("props"), "\n").alias("lines"))
Q["two_line_wrap"] = lambda s, d: cues(s, d).select("job", "cue_id", dc.wrapped("text", 2200).alias("text"))
Q["normalised_text"] = lambda s, d: cues(s, d).select("job", "cue_id", dc.normalised("text").alias("text"))
SQL["normalised_text"] = sql(r"SELECT job, cue_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM cues", "cues")

Q["picture_layout"] = lambda s, d: dc.layout(table(s, d, "part").select("p_partkey", (F.col("p_partkey") % 1900 + 100).alias("w"), (F.col("p_partkey") % 700 + 300).alias("h")), "w", "h").select("p_partkey", "font", "margin", "capacity")
SQL["picture_layout"] = "SELECT p_partkey, font, margin, CAST(floor(100.0 * (w - 2 * margin) / font) AS BIGINT) AS capacity FROM (SELECT *, CAST(greatest(18, least(96, round(least(w, h) * 48 / 1080.0))) AS INT) AS font, CAST(round(w * CASE WHEN h > w THEN 0.06 ELSE 0.08 END) AS INT) AS margin FROM (SELECT p_partkey, p_partkey % 1900 + 100 AS w, p_partkey % 700 + 300 AS h FROM part))"
