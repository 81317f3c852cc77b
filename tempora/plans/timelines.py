"""Interval and sequence queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tempora.functions import text as tx
from tempora.functions.time import ass_time, srt_time
from tempora.operators import aggregates as ag
from tempora.operators import intervals as iv
from tempora.operators import keyed
from tempora.operators import sequence as sq
from tempora.plans.views import SQL_VIEWS, cues, regions, sql, table

Q: dict = {}
SQL: dict[str, str] = {}

ISLAND = """SELECT *, sum(fresh) OVER (PARTITION BY {k} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY {k} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS fresh FROM {t})"""
MERGED = "SELECT {k}, min(s) AS s, max(e) AS e FROM ({island}) GROUP BY {k}, island"


def merged(t: str, gap: int = 0, k: str = "job") -> str:
    return MERGED.format(k=k, island=ISLAND.format(k=k, gap=gap, t=t))


PAIRS = "SELECT a.job, a.rid AS rid_a, b.rid AS rid_b, greatest(a.s, b.s) AS s, least(a.e, b.e) AS e, least(a.label, b.label) AS label_lo, greatest(a.label, b.label) AS label_hi FROM regions a JOIN regions b ON a.job = b.job AND a.s < b.e AND b.s < a.e AND a.label <> b.label AND (a.s, a.e, a.rid) < (b.s, b.e, b.rid)"
POSITIVE = "SELECT job, s, e FROM regions WHERE e > s"
#: Fragments of `own` (job, rid, label, s, e) outside `cuts` (disjoint job, s, e).
FRAGMENTS = """SELECT job, rid, label, f AS s, cut_s AS e FROM (SELECT *, coalesce(lag(cut_e) OVER (PARTITION BY job, rid ORDER BY cut_s, cut_e), s) AS f FROM (
SELECT o.job, o.rid, o.label, o.s, o.e, greatest(o.s, c.s) AS cut_s, least(o.e, c.e) AS cut_e FROM {own} o JOIN {cuts} c ON o.job = c.job AND o.s < c.e AND c.s < o.e
UNION ALL SELECT job, rid, label, s, e, e, e FROM {own})) WHERE cut_s - f >= {least}"""
EXTENT = "SELECT job, min(s) AS low, max(e) AS high FROM regions GROUP BY job"
DAY = 86_400_000_000
HOUR = iv.HOUR


Q["interval_union_gap"] = lambda s, d: iv.union(regions(s, d), 1_000_000)
SQL["interval_union_gap"] = sql(merged("regions", 1_000_000), "regions")

Q["interval_union_strict"] = lambda s, d: iv.strict_union(regions(s, d), ("job", "label"))
SQL["interval_union_strict"] = sql(merged("(SELECT * FROM regions WHERE e > s)", 0, "job, label"), "regions")

Q["interval_overlap_pairs"] = lambda s, d: iv.overlap_pairs(regions(s, d), width=DAY, empty=True)
Q["interval_overlap_pairs_bucketed"] = lambda s, d: iv.overlap_pairs(regions(s, d), width=HOUR, empty=True)
SQL["interval_overlap_pairs"] = SQL["interval_overlap_pairs_bucketed"] = sql(PAIRS, "regions")

Q["interval_overlap_flag"] = lambda s, d: iv.overlap_flag(regions(s, d)).select("job", "rid", "overlaps")
SQL["interval_overlap_flag"] = sql("SELECT job, rid, EXISTS (SELECT 1 FROM regions b WHERE b.job = a.job AND a.s < b.e AND b.s < a.e AND a.label IS DISTINCT FROM b.label) AS overlaps FROM regions a", "regions")

Q["interval_coverage"] = lambda s, d: iv.coverage(regions(s, d).where("label = 'click'"), regions(s, d).where("label <> 'click'")).select("job", "rid", "covered")
SQL["interval_coverage"] = sql(
    "SELECT r.job, r.rid, CAST(coalesce(sum(CASE WHEN u.job IS NOT NULL THEN least(r.e, u.e) - greatest(r.s, u.s) END), 0) AS BIGINT) AS covered FROM regions r LEFT JOIN u ON r.job = u.job AND r.s < u.e AND u.s < r.e WHERE r.label = 'click' GROUP BY r.job, r.rid",
    "regions", u=merged("(SELECT * FROM regions WHERE label <> 'click' AND e > s)"),
)

Q["interval_subtract"] = lambda s, d: iv.subtract(regions(s, d).where("label = 'click'"), regions(s, d).where("label = 'view'"))
SQL["interval_subtract"] = sql(FRAGMENTS.format(own="own", cuts="cuts", least=80_000), "regions", own="SELECT * FROM regions WHERE label = 'click'", cuts=merged("(SELECT * FROM regions WHERE label = 'view' AND e > s)"))

Q["clean_timeline"] = lambda s, d: iv.clean_timeline(regions(s, d))
SQL["clean_timeline"] = sql(FRAGMENTS.format(own="regions", cuts="cuts", least=80_000), "regions", pairs=PAIRS, cuts=merged("pairs"))

Q["padded_overlap_spans"] = lambda s, d: iv.padded_overlaps(regions(s, d), longest=HOUR)
SQL["padded_overlap_spans"] = sql(
    f"SELECT job, s + i * {HOUR} AS s, least(e, s + (i + 1) * {HOUR}) AS e, i AS piece FROM (SELECT job, s, e, unnest(range(greatest(CAST(ceil((e - s) / {HOUR}.0) AS BIGINT), 1))) AS i FROM m)",
    "regions", pairs=PAIRS, x=EXTENT, wide="SELECT p.job, greatest(p.s - 750000, x.low) AS s, least(p.e + 750000, x.high) AS e FROM pairs p JOIN x ON p.job = x.job", m=merged("wide", 250_000),
)

Q["max_concurrency"] = lambda s, d: iv.max_concurrency(regions(s, d))
SQL["max_concurrency"] = sql(
    "SELECT job, max(n) AS most FROM (SELECT job, CAST(sum(d) OVER (PARTITION BY job ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS BIGINT) AS n FROM (SELECT job, s AS t, 1 AS d FROM m UNION ALL SELECT job, e, -1 FROM m)) GROUP BY job",
    "regions", m=merged("(SELECT * FROM regions WHERE e > s)", 0, "job, label"),
)


def _hops(s, d):
    return sq.hop_windows(iv.extent(regions(s, d)), 6 * HOUR, 3 * HOUR)


HOPS = f"""SELECT job, CAST(row_number() OVER (PARTITION BY job ORDER BY o) - 1 AS BIGINT) AS win, low + o AS s, least(low + o + {6 * HOUR}, high) AS e FROM (
SELECT job, low, high, unnest(CASE WHEN high - low <= {6 * HOUR} THEN [CAST(0 AS BIGINT)] ELSE list_distinct(list_concat([i * {3 * HOUR} FOR i IN range((high - low - {6 * HOUR}) // {3 * HOUR} + 1)], [high - low - {6 * HOUR}])) END) AS o FROM ({EXTENT}))"""
Q["hop_windows_tail"] = _hops
SQL["hop_windows_tail"] = sql(HOPS, "regions")

Q["dominant_label_per_window"] = lambda s, d: iv.dominant_label(_hops(s, d), regions(s, d))
SQL["dominant_label_per_window"] = sql(
    "SELECT job, win, label, CAST(overlap AS BIGINT) AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY job, win ORDER BY overlap DESC, seen) AS n FROM (SELECT h.job, h.win, r.label, sum(least(h.e, r.e) - greatest(h.s, r.s)) AS overlap, min((r.s, r.rid)) AS seen FROM h JOIN regions r ON h.job = r.job AND h.s < r.e AND r.s < h.e AND h.e > h.s AND r.e > r.s WHERE r.label IS NOT NULL GROUP BY ALL)) WHERE n = 1",
    "regions", h=HOPS,
)

Q["cue_label_assignment"] = lambda s, d: iv.assign_label(regions(s, d).where("label = 'click'"), regions(s, d).where("label <> 'click'"), pad=60_000_000).select("job", "rid", "speaker")
SQL["cue_label_assignment"] = sql(
    """SELECT c.job, c.rid, CASE WHEN in_n > 1 THEN NULL WHEN in_n = 1 AND 100 * in_most >= 35 * (c.e - c.s) THEN in_label WHEN out_n = 1 AND 100 * out_most >= 35 * (c.e - c.s) AND (in_n = 0 OR in_label = out_label) THEN out_label END AS speaker
FROM c LEFT JOIN (SELECT job, rid, count(*) FILTER (i = in_m AND i > 0) AS in_n, max(label) FILTER (i = in_m AND i > 0) AS in_label, max(in_m) AS in_most, count(*) FILTER (o = out_m AND o > 0) AS out_n, max(label) FILTER (o = out_m AND o > 0) AS out_label, max(out_m) AS out_most
FROM (SELECT *, max(i) OVER (PARTITION BY job, rid) AS in_m, max(o) OVER (PARTITION BY job, rid) AS out_m FROM t) GROUP BY job, rid) x ON c.job = x.job AND c.rid = x.rid""",
    "regions", c="SELECT * FROM regions WHERE label = 'click'",
    t="SELECT c.job, c.rid, r.label, sum(greatest(0, least(c.e, r.e) - greatest(c.s, r.s))) AS i, sum(greatest(0, least(c.e, r.e + 60000000) - greatest(c.s, r.s - 60000000))) AS o FROM c JOIN regions r ON c.job = r.job AND c.s - 60000000 < r.e AND r.s < c.e + 60000000 AND r.e > r.s AND c.e > c.s WHERE r.label <> 'click' GROUP BY ALL",
)

Q["smallest_container"] = lambda s, d: iv.smallest_container(regions(s, d), regions(s, d)).select("job", "rid", "container")
SQL["smallest_container"] = sql("SELECT a.job, a.rid, arg_min(b.rid, (b.e - b.s, b.rid)) AS container FROM regions a LEFT JOIN regions b ON a.job = b.job AND b.s <= a.s AND a.e <= b.e AND a.rid <> b.rid AND a.e > a.s GROUP BY a.job, a.rid", "regions")

Q["context_windows"] = lambda s, d: iv.context_windows(regions(s, d), least=1_800_000_000, context=600_000_000)
SQL["context_windows"] = sql(
    "SELECT m.job, m.s, m.e, string_agg(DISTINCT r.label, ',' ORDER BY r.label) AS labels, count(*) AS turns FROM m JOIN regions r ON m.job = r.job AND m.s < r.e AND r.s < m.e AND r.e > r.s WHERE m.e > m.s GROUP BY m.job, m.s, m.e",
    "regions", pairs=PAIRS, x=EXTENT, wide="SELECT p.job, greatest(p.s - 600000000, x.low) AS s, least(p.e + 600000000, x.high) AS e FROM pairs p JOIN x ON p.job = x.job WHERE p.e - p.s >= 1800000000", m=merged("wide"),
)

Q["coalesce_runs"] = lambda s, d: iv.coalesce_runs(regions(s, d), ("label",), gap=3_600_000_000, longest=4 * HOUR)

SQL["coalesce_runs"] = (
    f"WITH RECURSIVE {SQL_VIEWS['regions']}, m AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY s, e, label) AS i FROM regions), "
    "p AS (SELECT job, i, s, e, label, 0 AS n FROM m WHERE i = 1 "
    f"UNION ALL SELECT job, i, CASE WHEN fits THEN ps ELSE s END, CASE WHEN fits THEN greatest(pe, e) ELSE e END, label, n + CASE WHEN fits THEN 0 ELSE 1 END FROM (SELECT m.*, p.s AS ps, p.e AS pe, p.n, m.label = p.label AND m.s - p.e <= 3600000000 AND greatest(p.e, m.e) - p.s <= {4 * HOUR} AS fits FROM p JOIN m ON m.job = p.job AND m.i = p.i + 1)) "
    "SELECT job, min(s) AS s, max(e) AS e, max(label) AS label FROM p GROUP BY job, n"
)

Q["trim_overlaps"] = lambda s, d: iv.trim_overlaps(cues(s, d)).select("job", "cue_id", "s", "e")
SQL["trim_overlaps"] = sql(
    """SELECT job, cue_id, s, least(e, coalesce(CASE WHEN speaker IS NULL THEN any_s ELSE least(coalesce(same_s, null_s), coalesce(null_s, same_s)) END, e)) AS e FROM (SELECT *, min(s) OVER a AS any_s,
min(s) OVER (PARTITION BY job, speaker ORDER BY cue_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS same_s, min(CASE WHEN speaker IS NULL THEN s END) OVER a AS null_s FROM cues WINDOW a AS (PARTITION BY job ORDER BY cue_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))""",
    "cues",
)


def _owned(s, d):
    return sq.overlapping_windows(iv.extent(regions(s, d)), 6 * HOUR, HOUR)


OWNED = f"""SELECT job, win, s, e, coalesce(CAST(floor((lag(e) OVER w + s) / 2.0) AS BIGINT), s) AS keep_s, coalesce(CAST(floor((e + lead(s) OVER w) / 2.0) AS BIGINT), e) AS keep_e, lead(s) OVER w IS NULL AS final FROM (
SELECT job, win, low + win * {5 * HOUR} AS s, least(low + win * {5 * HOUR} + {6 * HOUR}, high) AS e FROM (SELECT *, unnest(range(greatest(1, CAST(ceil((high - low - {HOUR}) / {5 * HOUR}.0) AS BIGINT)))) AS win FROM ({EXTENT}))) WINDOW w AS (PARTITION BY job ORDER BY win)"""
Q["overlap_windows_owned"] = _owned
SQL["overlap_windows_owned"] = sql(OWNED, "regions")

Q["ownership_clamp"] = lambda s, d: iv.own_units(regions(s, d), _owned(s, d))
SQL["ownership_clamp"] = sql(
    "SELECT o.job, o.win, r.rid, greatest(r.s, o.keep_s) AS s, least(greatest(least(r.e, o.keep_e), greatest(r.s, o.keep_s) + 80000), o.keep_e) AS e FROM o JOIN regions r ON o.job = r.job AND (r.s + r.e) / 2.0 >= o.keep_s AND ((r.s + r.e) / 2.0 < o.keep_e OR (o.final AND (r.s + r.e) / 2.0 = o.keep_e))",
    "regions", o=OWNED,
)


def _repairs(s, d):
    base = regions(s, d)
    rows = base.select("job", "rid", F.col("label").alias("speaker"), F.when(F.col("label") == "error", "singing").otherwise("speech").alias("kind"), "s", "e")
    windows = base.where("label = 'purchase' and e > s").select("job", "s", "e", F.array(F.lit("click"), F.lit("view")).alias("speakers"))
    fixed = rows.where("speaker = 'purchase'").select("job", (-F.col("rid") - 1).alias("rid"), "speaker", "kind", "s", "e")
    return iv.replace_windows(rows, fixed, windows)


Q["midpoint_replace"] = _repairs
SQL["midpoint_replace"] = sql(
    "SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM regions w WHERE w.job = b.job AND w.label = 'purchase' AND w.e > w.s AND (b.s + b.e) / 2.0 >= w.s AND (b.s + b.e) / 2.0 < w.e AND b.kind <> 'singing' AND b.speaker IN ('click', 'view')) UNION ALL SELECT job, -rid - 1, speaker, kind, s, e FROM b WHERE speaker = 'purchase'",
    "regions", b="SELECT job, rid, label AS speaker, CASE WHEN label = 'error' THEN 'singing' ELSE 'speech' END AS kind, s, e FROM regions",
)

Q["activity_masks"] = lambda s, d: iv.activity_masks(regions(s, d), HOUR).groupBy("job", "label", "state").agg(F.count("*").alias("frames"))
SQL["activity_masks"] = sql(
    "SELECT f.job, t.label, CASE WHEN NOT list_contains(f.active, t.label) THEN 'non_target' WHEN len(f.active) > 1 THEN 'overlap' ELSE 'target_only' END AS state, count(*) AS frames FROM f JOIN (SELECT DISTINCT job, label FROM regions) t ON f.job = t.job GROUP BY ALL",
    "regions", f=f"SELECT job, frame, list(DISTINCT label) AS active FROM (SELECT job, label, unnest(range(s // {HOUR}, (e - 1) // {HOUR} + 1)) AS frame FROM regions WHERE e > s) GROUP BY job, frame",
)

Q["moving_median_padded"] = lambda s, d: sq.moving_median(table(s, d, "events").select("user_id", "event_id", "value"), "value", 5, ("user_id",), ("event_id",)).select("event_id", F.round("smooth", 6).alias("smooth"))
SQL["moving_median_padded"] = "SELECT event_id, round(list_sort(list_concat(l, list_transform(range(5 - len(l)), lambda x: 0.0)))[3], 6) AS smooth FROM (SELECT event_id, list(coalesce(value, 0.0)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS l FROM events)"


def _scores(s, d):
    return regions(s, d).join(table(s, d, "events").select(F.col("event_id").alias("rid"), "value"), "rid").select("job", "s", "e", (F.col("value") / 490).alias("raw"), F.when(F.col("label") == "view", 0.8).otherwise(0.1).alias("speech"), F.when(F.col("label") == "click", 0.7).otherwise(0.05).alias("music"))


Q["hysteresis_episodes"] = lambda s, d: sq.hysteresis_episodes(_scores(s, d), 0.3, 0.5, 12 * HOUR)

Q["arbitrate_candidates"] = lambda s, d: sq.arbitrate(
    regions(s, d).where("label = 'click'").withColumn("confidence", (F.col("e") - F.col("s")).cast("double")), regions(s, d).where("label = 'purchase'").withColumn("confidence", (F.col("e") - F.col("s")).cast("double")), regions(s, d).where("label = 'view'"), HOUR
)
SQL["arbitrate_candidates"] = sql(
    "SELECT job, s, e, anchor AS confidence, 'confirmed' AS verdict FROM conf UNION ALL SELECT f.job, f.s, f.e, CAST(f.label AS DOUBLE), 'ambiguous' FROM (" + FRAGMENTS.format(own="amb", cuts="cc", least=1) + ") f",
    "regions",
    c="SELECT job, row_number() OVER (PARTITION BY job ORDER BY min(s)) AS rid, min(s) AS s, max(e) AS e, CAST(max(e - s) AS DOUBLE) AS confidence FROM (" + ISLAND.format(k="job", gap=HOUR, t="(SELECT * FROM regions WHERE label = 'click')") + ") GROUP BY job, island",
    v=merged("(SELECT * FROM regions WHERE label = 'view' AND e > s)"),
    j="SELECT c.*, (SELECT CAST(max(p.e - p.s) AS DOUBLE) FROM regions p WHERE p.label = 'purchase' AND p.job = c.job AND p.s < c.e AND c.s < p.e AND p.e > p.s AND c.e > c.s) AS anchor, (SELECT coalesce(sum(least(v.e, c.e) - greatest(v.s, c.s)), 0) FROM v WHERE v.job = c.job AND v.s < c.e AND c.s < v.e) AS covered FROM c",
    conf="SELECT * FROM j WHERE anchor IS NOT NULL", cc=merged("(SELECT job, s, e FROM conf WHERE e > s)"),
    amb="SELECT job, rid, confidence AS label, s, e FROM j WHERE anchor IS NULL AND covered < 0.35 * (e - s)",
)

Q["session_gap"] = lambda s, d: sq.sessions(regions(s, d), 6 * HOUR, extra=(F.count("*").alias("events"), F.min("rid").alias("first_id"), F.max("rid").alias("last_id")))
SQL["session_gap"] = sql("SELECT job, min(s) AS s, max(e) AS e, count(*) AS events, min(rid) AS first_id, max(rid) AS last_id FROM (" + ISLAND.format(k="job", gap=6 * HOUR, t="regions") + ") GROUP BY job, island", "regions")

Q["pack_windows"] = lambda s, d: sq.pack_windows(regions(s, d), HOUR, 2 * HOUR, 4 * HOUR, 12 * HOUR, 18 * HOUR)
Q["min_length_coalesce"] = lambda s, d: sq.least_length(regions(s, d), 12 * HOUR, HOUR)
SQL["min_length_coalesce"] = (
    f"WITH RECURSIVE {SQL_VIEWS['regions']}, m AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY s) AS i FROM ({merged('regions', HOUR)})), "
    f"p AS (SELECT job, i, e, CASE WHEN e - s >= {12 * HOUR} THEN e ELSE s END AS edge, CASE WHEN e - s >= {12 * HOUR} THEN 1 ELSE 0 END AS n FROM m WHERE i = 1 "
    f"UNION ALL SELECT m.job, m.i, m.e, CASE WHEN m.e - p.edge >= {12 * HOUR} THEN m.e ELSE p.edge END, CASE WHEN m.e - p.edge >= {12 * HOUR} THEN p.n + 1 ELSE p.n END FROM p JOIN m ON m.job = p.job AND m.i = p.i + 1), "
    "x AS (SELECT job, min(s) AS first, max(e) AS last FROM m GROUP BY job), b AS (SELECT job, n, min(edge) AS e FROM p WHERE n > 0 GROUP BY job, n) "
    "SELECT b.job, coalesce(lag(b.e) OVER w, x.first) AS s, CASE WHEN lead(b.e) OVER w IS NULL THEN x.last ELSE b.e END AS e FROM b JOIN x ON b.job = x.job WINDOW w AS (PARTITION BY b.job ORDER BY n) "
    "UNION ALL SELECT job, first, last FROM x WHERE job NOT IN (SELECT job FROM b)"
)
Q["lane_assignment"] = lambda s, d: sq.lanes(regions(s, d)).select("job", "rid", "lane")
SQL["lane_assignment"] = (
    f"WITH RECURSIVE {SQL_VIEWS['regions']}, m AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY s, e, rid) AS i FROM regions WHERE e > s), "
    "p AS (SELECT job, i, rid, CAST(0 AS INT) AS lane, [e] AS busy FROM m WHERE i = 1 "
    "UNION ALL SELECT job, i, rid, CAST(lane AS INT), list_concat(busy[:lane], [e], busy[lane + 2:]) FROM (SELECT m.*, p.busy, coalesce(list_position(list_transform(p.busy, lambda x: x <= m.s), true) - 1, len(p.busy)) AS lane FROM p JOIN m ON m.job = p.job AND m.i = p.i + 1)) "
    "SELECT job, rid, lane FROM p"
)

Q["count_windows"] = lambda s, d: sq.count_windows(cues(s, d), 3).select("job", "cue_id", "window")
SQL["count_windows"] = sql("SELECT job, cue_id, i // 3 + CASE WHEN n % 3 = 1 AND n > 1 AND i = n - 2 THEN 1 ELSE 0 END AS \"window\" FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY cue_id) - 1 AS i, count(*) OVER (PARTITION BY job) AS n FROM cues)", "cues")

Q["budget_packing"] = lambda s, d: sq.pack_by_budget(cues(s, d).withColumn("n", F.length("text")), "n", 800, 3)
SQL["budget_packing"] = (
    "WITH RECURSIVE r AS (SELECT conv_id AS job, CAST(turn AS BIGINT) AS cue_id, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations), p AS (SELECT job, cue_id, i, n AS total, 1 AS m, CAST(0 AS BIGINT) AS batch FROM r WHERE i = 1 "
    "UNION ALL SELECT r.job, r.cue_id, r.i, CASE WHEN p.total + r.n > 800 OR p.m >= 3 THEN r.n ELSE p.total + r.n END, CASE WHEN p.total + r.n > 800 OR p.m >= 3 THEN 1 ELSE p.m + 1 END, CASE WHEN p.total + r.n > 800 OR p.m >= 3 THEN p.batch + 1 ELSE p.batch END FROM p JOIN r ON r.job = p.job AND r.i = p.i + 1) SELECT job, cue_id, batch FROM p"
)

BOUNDARY = "SELECT *, coalesce(coalesce(speaker, 'unknown') <> lead(coalesce(speaker, 'unknown')) OVER w OR lead(s) OVER w - e >= 250000, false) AS boundary FROM cues WINDOW w AS (PARTITION BY job ORDER BY cue_id)"
Q["candidate_boundaries"] = lambda s, d: sq.candidate_boundaries(cues(s, d)).select("job", "cue_id", "boundary")
SQL["candidate_boundaries"] = sql(f"SELECT job, cue_id, boundary FROM ({BOUNDARY})", "cues")


def _paused(s, d):
    return cues(s, d).withColumn("boundary", F.length("text") % 3 == 0)


Q["run_merge_by_boundary"] = lambda s, d: sq.merge_runs(_paused(s, d)).drop("run")
#: Two fragments as one text: a hyphen joins, CJK edges touch, anything else gets a space.
#: (a and b have single spaces)
FRAGMENT_JOIN = "CASE WHEN a = '' THEN b WHEN b = '' THEN a WHEN a LIKE '%-' AND a NOT LIKE '%--' THEN a[:-2] || b WHEN regexp_matches(a, '[{cjk}][，、；：—]*$') AND regexp_matches(b, '^[{cjk}]') THEN a || b ELSE a || ' ' || b END".format(cjk=tx.CJK)
SQL["run_merge_by_boundary"] = sql(
    f"SELECT job, min(cue_id) AS first_id, max(cue_id) AS last_id, arg_min(s, cue_id) AS s, arg_max(e, cue_id) AS e, list_reduce(list(trim(regexp_replace(text, '\\s+', ' ', 'g')) ORDER BY cue_id), lambda a, b: {FRAGMENT_JOIN}) AS text, CASE WHEN count(DISTINCT speaker) = 1 AND count(speaker) = count(*) THEN max(speaker) END AS speaker, CASE WHEN count(DISTINCT kind) = 1 THEN max(kind) ELSE 'mixed' END AS kind FROM (SELECT *, sum(coalesce(b, 0)) OVER (PARTITION BY job ORDER BY cue_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(CASE WHEN length(text) % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY cue_id) AS b FROM cues)) GROUP BY job, run",
    "cues",
)

Q["nearest_split"] = lambda s, d: sq.nearest_split(cues(s, d))
SQL["nearest_split"] = sql(f"SELECT job, arg_min(cue_id, (abs(2 * cue_id - low - high), cue_id)) AS split_id FROM (SELECT *, min(cue_id) OVER (PARTITION BY job) AS low, max(cue_id) OVER (PARTITION BY job) AS high FROM ({BOUNDARY})) WHERE boundary GROUP BY job", "cues")

Q["evidence_chunks"] = lambda s, d: sq.evidence_chunks(regions(s, d), longest=HOUR, shortest=600_000_000).select("job", "rid", "piece", "s", "e")
SQL["evidence_chunks"] = sql(
    "SELECT job, rid, i AS piece, s + (e - s) * i // n AS s, s + (e - s) * (i + 1) // n AS e FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *, CAST(ceil((e - s) / 3600000000.0) AS BIGINT) AS n FROM (SELECT job, rid, s + 150000 AS s, e - 150000 AS e FROM regions) WHERE e - s >= 600000000))",
    "regions",
)


def _weighted(s, d):
    parts = cues(s, d).select("job", "cue_id", "s", "e", F.posexplode(F.split("text", r"\.")).alias("part", "words"))
    return parts.withColumn("weight", F.length("words") + 1)


Q["proportional_split"] = lambda s, d: sq.proportional_split(_weighted(s, d), ("job", "cue_id"), "part", "weight").select("job", "cue_id", F.col("part").cast("long").alias("part"), "part_s", "part_e")
SQL["proportional_split"] = sql(
    "SELECT job, cue_id, part, s + CAST(floor((e - s) * (u - w) / t) AS BIGINT) AS part_s, s + CAST(floor((e - s) * u / t) AS BIGINT) AS part_e FROM (SELECT *, CAST(sum(w) OVER (PARTITION BY job, cue_id ORDER BY part ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS u, CAST(sum(w) OVER (PARTITION BY job, cue_id) AS DOUBLE) AS t FROM (SELECT job, cue_id, s, e, length(p) + 1 AS w, row_number() OVER (PARTITION BY job, cue_id ORDER BY i) - 1 AS part FROM (SELECT job, cue_id, s, e, unnest(string_split(text, '.')) AS p, generate_subscripts(string_split(text, '.'), 1) AS i FROM cues)))",
    "cues",
)


def _runs(s, d):
    ids = cues(s, d).where("cue_id % 3 = 1").select("job", F.col("cue_id").alias("first_id"), (F.col("cue_id") + 1).alias("last_id"), F.upper("speaker").alias("text"), F.when(F.length("text") % 2 == 0, "high").otherwise("low").alias("confidence"))
    return sq.replace_runs(cues(s, d), ids)


Q["run_replace"] = _runs
SQL["run_replace"] = sql(
    "SELECT c.job, c.cue_id, c.s, c.e, c.text FROM cues c LEFT JOIN r ON c.job = r.job AND c.cue_id BETWEEN r.a AND r.b WHERE r.job IS NULL UNION ALL SELECT c.job, r.a, min(c.s), max(c.e), any_value(r.t) FROM cues c JOIN r ON c.job = r.job AND c.cue_id BETWEEN r.a AND r.b GROUP BY c.job, r.a",
    "cues", r="SELECT job, cue_id AS a, cue_id + 1 AS b, upper(speaker) AS t FROM cues WHERE cue_id % 3 = 1 AND length(text) % 2 = 0",
)


def _marked(s, d):
    base = cues(s, d)
    texts = base.groupBy("job").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cue_id", "text"))), lambda x: x["text"]), "").alias("whole"))
    return sq.separator_ranges(base, texts.select("job", F.concat(F.left("whole", F.lit(40)), F.lit("｜"), F.expr("substring(whole, 41)")).alias("marked")))


Q["separator_ranges"] = _marked
SQL["separator_ranges"] = sql(
    "SELECT job, coalesce(lag(end_id) OVER (PARTITION BY job ORDER BY end_id) + 1, first) AS start_id, end_id FROM (SELECT DISTINCT u.job, u.first, (SELECT min(v.cue_id) FROM u v WHERE v.job = u.job AND v.upto >= c.cut) AS end_id FROM u JOIN (SELECT job, unnest([least(40, max(upto)), max(upto)]) AS cut FROM u GROUP BY job) c ON u.job = c.job)",
    "cues", u="SELECT job, cue_id, min(cue_id) OVER (PARTITION BY job) AS first, CAST(sum(length(text)) OVER (PARTITION BY job ORDER BY cue_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM cues",
)

Q["srt_render"] = lambda s, d: cues(s, d).select("job", "cue_id", F.concat(F.row_number().over(sq._over(("job",), "s", "e", "cue_id")).cast("string"), F.lit("\n"), srt_time(F.col("s")), F.lit(" --> "), srt_time(F.col("e")), F.lit("\n"), F.trim("text")).alias("block"), ass_time(F.col("e")).alias("ass_end"))
SRT = "printf('%02d:%02d:%02d,%03d', m // 3600000, m // 60000 % 60, m // 1000 % 60, m % 1000)"
SQL["srt_render"] = sql(
    f"SELECT job, cue_id, n || chr(10) || (SELECT {SRT} FROM (SELECT (s + 500) // 1000 AS m)) || ' --> ' || (SELECT {SRT} FROM (SELECT (e + 500) // 1000 AS m)) || chr(10) || trim(text) AS block, (SELECT printf('%d:%02d:%02d.%02d', m // 360000, m // 6000 % 60, m // 100 % 60, m % 100) FROM (SELECT (e + 5000) // 10000 AS m)) AS ass_end FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY s, e, cue_id) AS n FROM cues)",
    "cues",
)

Q["id_coverage_check"] = lambda s, d: keyed.coverage_errors(
    cues(s, d).where("cue_id % 4 <> 2").select("job", F.col("cue_id").alias("start_id"), F.col("cue_id").alias("end_id")), cues(s, d).groupBy("job").agg(F.min("cue_id").alias("first_id"), F.max("cue_id").alias("last_id"))
)
SQL["id_coverage_check"] = sql(
    "SELECT * FROM (SELECT r.job, coalesce(lag(r.cue_id) OVER (PARTITION BY r.job ORDER BY r.cue_id) + 1, b.f) AS expected, r.cue_id AS found, 'start' AS at FROM cues r JOIN b ON r.job = b.job WHERE r.cue_id % 4 <> 2 UNION ALL SELECT r.job, max(b.l), max(r.cue_id), 'end' FROM cues r JOIN b ON r.job = b.job WHERE r.cue_id % 4 <> 2 GROUP BY r.job) WHERE expected <> found",
    "cues", b="SELECT job, min(cue_id) AS f, max(cue_id) AS l FROM cues GROUP BY job",
)

Q["majority_vote_null_tie"] = lambda s, d: ag.majority(cues(s, d), ("job",), "speaker")
SQL["majority_vote_null_tie"] = sql("SELECT job, CASE WHEN count(*) FILTER (n = m AND n > 0) = 1 THEN max(speaker) FILTER (n = m AND n > 0) END AS winner FROM (SELECT *, max(n) OVER (PARTITION BY job) AS m FROM (SELECT job, speaker, count(speaker) AS n FROM cues GROUP BY ALL)) GROUP BY job", "cues")

Q["uniform_or_mixed"] = lambda s, d: ag.uniform_or(cues(s, d).withColumn("pair", F.floor(F.col("cue_id") / 2)), ("job", "pair"), "kind")
SQL["uniform_or_mixed"] = sql("SELECT job, cue_id // 2 AS pair, CASE WHEN count(DISTINCT kind) = 1 AND count(kind) = count(*) THEN max(kind) WHEN count(kind) = 0 THEN NULL ELSE 'mixed' END AS value FROM cues GROUP BY job, cue_id // 2", "cues")

Q["majority_start_share"] = lambda s, d: ag.majority_share(regions(s, d), ("job",), F.floor(F.col("s") / HOUR))
SQL["majority_start_share"] = sql(f"SELECT job, max(n) AS most, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT job, s // {HOUR} AS h, count(*) AS n FROM regions GROUP BY ALL) GROUP BY job", "regions")

Q["stage_rollup"] = lambda s, d: ag.stage_rollup(table(s, d, "events").select(F.col("event_type").alias("name"), F.when(F.col("value") < 5, "failed").otherwise("completed").alias("status"), F.round(F.col("value") * 1000).cast("long").alias("elapsed_ms"), F.when(F.col("event_type") != "view", (F.col("event_id") % 1000).cast("long")).alias("peak_mib")))
SQL["stage_rollup"] = "SELECT event_type AS name, count(*) AS calls, count(*) FILTER (NOT coalesce(value < 5, false)) AS completed, count(*) FILTER (value < 5) AS failed, CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS total_ms, max(CAST(round(value * 1000) AS BIGINT)) AS longest_ms, max(CASE WHEN event_type <> 'view' THEN CAST(event_id % 1000 AS BIGINT) END) AS peak_mib FROM events GROUP BY 1"
