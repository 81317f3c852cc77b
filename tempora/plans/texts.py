"""Text, dictionary, vector and keyed queries with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.functions import text as tx
from tempora.operators import aggregates as ag
from tempora.operators import joins, keyed, vectors
from tempora.plans.views import cues, documents, sql, table

Q: dict = {}
SQL: dict[str, str] = {}

Q["display_width"] = lambda s, d: documents(s, d).select("doc_id", tx.display_width(F.col("text")).alias("width"))


def _count(pattern: str) -> str:
    return f"(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')))"


def _width_sql() -> str:
    space, combining, wide = (_count(c) for c in (tx.space_class(), tx.combining_class(), tx.wide_class()))
    return f"SELECT doc_id, CAST(35 * {space} + 100 * {wide} + 55 * (length(text) - {space} - {combining} - {wide}) AS BIGINT) AS width FROM documents"


SQL["display_width"] = _width_sql()

Q["strip_punctuation"] = lambda s, d: documents(s, d).select("doc_id", F.sha2(tx.without_punctuation(F.col("text")), 256).alias("digest"))
SQL["strip_punctuation"] = f"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '{tx.punctuation_class()}', '', 'g'), '{tx.space_class()}+', ' ', 'g'))) AS digest FROM documents"

Q["loop_detect"] = lambda s, d: documents(s, d).select("doc_id", tx.repetition_loops(F.col("text")).alias("loop")).where("loop is not null").select("doc_id", tx.loop_phrase(F.col("loop")).alias("phrase"), F.length("loop").alias("span"))

Q["script_errors"] = lambda s, d: documents(s, d).select("doc_id", F.array_join(F.array_compact(F.array(F.when(F.trim("text") == "", "empty"), F.when(F.col("text").rlike("[぀-ヿ]"), "kana"), F.when(F.col("text").rlike("[À-ɏ]"), "accented"))), ",").alias("errors"))
SQL["script_errors"] = "SELECT doc_id, concat_ws(',', CASE WHEN trim(text) = '' THEN 'empty' END, CASE WHEN regexp_matches(text, '[぀-ヿ]') THEN 'kana' END, CASE WHEN regexp_matches(text, '[À-ɏ]') THEN 'accented' END) AS errors FROM documents"

Q["bracket_marker_clean"] = lambda s, d: cues(s, d).select("job", "cue_id", tx.without_markers(F.concat(F.lit("[Music] "), F.col("text"), F.lit(" [ background  music ] [verse]"))).alias("text"))
SQL["bracket_marker_clean"] = sql(
    r"SELECT job, cue_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace('[Music] ' || text || ' [ background  music ] [verse]', '(?i)\[\s*(?:background\s+music|music)\s*\]', '', 'g'), '\r\n|\r', chr(10), 'g'), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM cues",
    "cues",
)

Q["head_mid_tail_sample"] = lambda s, d: documents(s, d).select("doc_id", tx.sample_thirds(F.col("text"), 300).alias("sample"))
SQL["head_mid_tail_sample"] = "SELECT doc_id, CASE WHEN length(text) <= 300 THEN text ELSE left(left(text, 100) || chr(10) || '...' || chr(10) || substr(text, CAST(length(text) // 2 - 49 AS BIGINT), 100) || chr(10) || '...' || chr(10) || right(text, 100), 300) END AS sample FROM documents"


def _tokens(s, d):
    return documents(s, d).select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "token"))


Q["ci_distinct_limit"] = lambda s, d: keyed.distinct_limited(_tokens(s, d), ("doc_id",), "token", "pos", 8).select("doc_id", F.col("pos").cast("long").alias("pos"), "tag", F.col("place").cast("long").alias("place"))
TOKENS = "SELECT doc_id, i - 1 AS pos, t AS token FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS t, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)"
SQL["ci_distinct_limit"] = sql(
    "SELECT doc_id, pos, tag, place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(tag) ORDER BY pos) AS n FROM (SELECT doc_id, pos, left(replace(trim(regexp_replace(ltrim(token), '^#+', '')), ',', ' '), 20) AS tag FROM t) WHERE tag <> '') WHERE n = 1) WHERE place <= 8",
    t=TOKENS,
)

Q["utf16_length"] = lambda s, d: documents(s, d).select("doc_id", tx.utf16_units(F.col("text")).alias("units"), F.length(tx.truncated_utf16(F.col("text"), 2000)).cast("long").alias("kept"))
SQL["utf16_length"] = r"SELECT doc_id, length(text) + length(regexp_replace(text, '[\x{0}-\x{ffff}]', '', 'g')) AS units, least(length(text), 2000) AS kept FROM documents"



def _neighbours(s, d):
    """A turn, and the next one after some characters of this one again."""
    following = F.lead("text").over(Window.partitionBy("job").orderBy("cue_id"))
    return cues(s, d).withColumn("following", F.concat(F.right("text", (F.col("cue_id") * 7 % 90).cast("int")), F.lit(" "), following)).where("following is not null")


NEIGHBOURS = "SELECT * FROM (SELECT *, right(text, cue_id * 7 % 90) || ' ' || lead(text) OVER (PARTITION BY job ORDER BY cue_id) AS following FROM cues) WHERE following IS NOT NULL"
Q["tail_prefix_overlap"] = lambda s, d: _neighbours(s, d).select("job", "cue_id", tx.overlap_length(F.col("text"), F.col("following")).cast("long").alias("shared"))
SQL["tail_prefix_overlap"] = sql(
    f"SELECT job, cue_id, CAST(coalesce(list_max(list_filter(range(3, 81), lambda n: n <= length(a) AND n <= length(b) AND right(a, n) = left(b, n))), 0) AS BIGINT) AS shared FROM (SELECT job, cue_id, regexp_replace(text, '{tx.space_class()}', '', 'g') AS a, regexp_replace(following, '{tx.space_class()}', '', 'g') AS b FROM n)",
    "cues", n=NEIGHBOURS,
)
Q["without_overlap"] = lambda s, d: _neighbours(s, d).select("job", "cue_id", tx.without_overlap(F.col("text"), F.col("following")).alias("rest"))

Q["numbered_lines"] = lambda s, d: documents(s, d).select("doc_id", F.sha2(tx.numbered_lines(F.col("text")), 256).alias("digest"))
SQL["numbered_lines"] = "SELECT doc_id, sha256(array_to_string(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> ''), lambda x, i: 'L' || i || ': ' || x), chr(10))) AS digest FROM documents"

Q["prompt_escape"] = lambda s, d: table(s, d, "pages").select("page_id", F.sha2(tx.without_prompt_marks(F.col("html")), 256).alias("digest"))
SQL["prompt_escape"] = "SELECT page_id, sha256(translate(translate(html, '<>｜', '＜＞￤'), chr(10), ' ')) AS digest FROM pages"

Q["sentence_ends"] = lambda s, d: cues(s, d).select("job", "cue_id", tx.ends_sentence(F.col("text")).alias("ends"))
SQL["sentence_ends"] = sql("""SELECT job, cue_id, regexp_matches(trim(text), '(?:[.!?。！？…]+|\\.{3,})["''”’」』）)\\]]*$') AS ends FROM cues""", "cues")

Q["signature_hash"] = lambda s, d: documents(s, d).select("doc_id", tx.canonical_hash(F.col("lang"), F.col("source"), F.col("text")).alias("signature"))
SQL["signature_hash"] = "SELECT doc_id, sha256(concat_ws(chr(0), coalesce(lang, ''), coalesce(source, ''), coalesce(text, ''))) AS signature FROM documents"

#: A small tag catalog for the alias queries (canonical, heat, ord, aliases).
CATALOG = [("article", 100, 0, ["the", "la"]), ("joiner", 20, 1, ["and", "the", "et"]), ("place", 50, 2, ["in", "de", "of"])]


def _catalog(s):
    return s.createDataFrame(CATALOG, "canonical string, heat int, ord int, aliases array<string>")


Q["alias_resolve_hottest"] = lambda s, d: joins.resolve_alias(_tokens(s, d), _catalog(s), "token").groupBy("canonical", "heat").agg(F.count("*").alias("n"))
SQL["alias_resolve_hottest"] = sql(
    "SELECT coalesce(b.c, t.token) AS canonical, coalesce(b.h, 0) AS heat, count(*) AS n FROM t LEFT JOIN (SELECT a, arg_max(c, (h, -o)) AS c, max(h) AS h FROM k GROUP BY a) b ON lower(t.token) = b.a GROUP BY 1, 2",
    t=TOKENS, k="SELECT * FROM (VALUES " + ", ".join(f"('{c}', {h}, {o}, '{a}')" for c, h, o, names in CATALOG for a in [c, *names]) + ") v(c, h, o, a)",
)

#: A small glossary (name, always, match).
GLOSSARY = [("base", True, []), ("english", False, ["the ", "ing"]), ("german", False, ["UND", "ein"]), ("spanish", False, ["ción"])]
Q["dictionary_trigger"] = lambda s, d: joins.trigger(documents(s, d), s.createDataFrame(GLOSSARY, "name string, always boolean, match array<string>"), F.col("text")).select("doc_id", "name")
SQL["dictionary_trigger"] = "SELECT d.doc_id, g.name FROM documents d JOIN (VALUES ('base', true, ['-']), ('english', false, ['the ', 'ing']), ('german', false, ['und', 'ein']), ('spanish', false, ['ción'])) g(name, always, m) ON g.always OR len(list_filter(g.m, lambda x: contains(lower(d.text), x))) > 0"

Q["unique_entity"] = lambda s, d: joins.unique_entity(documents(s, d).select("doc_id", "text"), s.createDataFrame([("A", "ouea"), ("A", "thion"), ("B", "erst"), ("C", "ção")], "entity string, alias string"), F.col("text")).select("doc_id", "entity")
SQL["unique_entity"] = "SELECT d.doc_id, CASE WHEN count(DISTINCT a.e) = 1 THEN max(a.e) END AS entity FROM documents d LEFT JOIN (VALUES ('A', 'ouea'), ('A', 'thion'), ('B', 'erst'), ('C', 'ção')) a(e, a) ON contains(lower(d.text), a.a) GROUP BY d.doc_id"

Q["identity_resolve"] = lambda s, d: joins.resolve_identity(cues(s, d).select("job", "cue_id", "speaker"), cues(s, d).select("job", F.col("speaker").alias("anonymous"), F.concat(F.col("speaker"), F.lit("_"), (F.col("cue_id") % 2).cast("string")).alias("resolved"), F.col("cue_id").alias("seq")), "speaker")
SQL["identity_resolve"] = sql("SELECT c.job, c.cue_id, coalesce(m.r, c.speaker) AS speaker FROM cues c LEFT JOIN (SELECT job, speaker, arg_max(speaker || '_' || (cue_id % 2), cue_id) AS r FROM cues GROUP BY job, speaker) m ON c.job = m.job AND c.speaker = m.speaker", "cues")

Q["id_reconcile"] = lambda s, d: keyed.reconcile(table(s, d, "labels").select("doc_id").unionByName(table(s, d, "labels").where("toxic = 1").select("doc_id")).unionByName(table(s, d, "labels").where("quality = 0").select((-F.col("doc_id") - 1).alias("doc_id"))), documents(s, d), "doc_id")
SQL["id_reconcile"] = sql(
    "SELECT doc_id, 'missing' AS issue FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM f) UNION ALL SELECT DISTINCT doc_id, 'unexpected' FROM f WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT doc_id, 'duplicate' FROM f GROUP BY doc_id HAVING count(*) > 1",
    f="SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1 UNION ALL SELECT -doc_id - 1 FROM labels WHERE quality = 0",
)

Q["keyed_accept_reject"] = lambda s, d: keyed.accept(documents(s, d).select("doc_id", "lang"), table(s, d, "labels"), "doc_id", {"low": F.col("quality") == 0, "toxic": F.col("toxic") == 1}).select("doc_id", F.array_join("reasons", ",").alias("reasons"), (F.size("reasons") == 0).alias("accepted"))
SQL["keyed_accept_reject"] = "SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE concat_ws(',', CASE WHEN quality = 0 THEN 'low' END, CASE WHEN toxic = 1 THEN 'toxic' END) END AS reasons, coalesce(quality <> 0 AND toxic <> 1, false) AS accepted FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"

Q["missing_only"] = lambda s, d: keyed.missing_only(documents(s, d).select("doc_id", "lang"), table(s, d, "labels"), ("doc_id",))
SQL["missing_only"] = "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"

Q["url_normalise_host"] = lambda s, d: table(s, d, "pages").select("page_id", keyed.normalise_url(F.col("url")).alias("url"), keyed.url_host(F.col("url")).alias("host"))
SQL["url_normalise_host"] = r"SELECT page_id, regexp_replace(trim(url), '\\([?=&])', '\1', 'g') AS url, lower(regexp_extract(regexp_replace(trim(url), '\\([?=&])', '\1', 'g'), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host FROM pages"

Q["response_codes"] = lambda s, d: table(s, d, "events").select("event_id", keyed.response_code(F.concat(F.lit("HTTP "), (400 + F.col("event_id") % 30).cast("string"))).alias("code"), keyed.failure_class((400 + F.col("event_id") % 120).cast("int"), F.lit("")).alias("failure"))
SQL["response_codes"] = "SELECT event_id, CASE WHEN event_id % 30 IN (6, 12, 29) THEN CAST(400 + event_id % 30 AS INT) END AS code, CASE WHEN 400 + event_id % 120 IN (408, 409, 425, 429) OR 400 + event_id % 120 BETWEEN 500 AND 599 THEN 'transient' ELSE 'fatal' END AS failure FROM events"

Q["token_usage"] = lambda s, d: ag.hit_rate(table(s, d, "lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_quantity").cast("long").alias("prompt"), F.col("l_linenumber").cast("long").alias("completion"), F.least(F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")).alias("hit"), F.lit(None).cast("long").alias("miss")), ("stage",))
SQL["token_usage"] = "SELECT l_returnflag AS stage, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS prompt, CAST(sum(l_linenumber) AS BIGINT) AS completion, CAST(sum(least(CAST(l_quantity AS BIGINT), l_linenumber)) AS BIGINT) AS hit, CAST(sum(CAST(l_quantity AS BIGINT) - least(CAST(l_quantity AS BIGINT), l_linenumber)) AS BIGINT) AS miss, CAST(floor(1000000.0 * sum(least(CAST(l_quantity AS BIGINT), l_linenumber)) / sum(CAST(l_quantity AS BIGINT))) AS BIGINT) AS hit_ppm FROM lineitem GROUP BY 1"

Q["label_families"] = lambda s, d: ag.family_scores(table(s, d, "events").select(F.col("user_id").alias("win"), F.col("event_type").alias("label"), F.col("event_id").alias("score")), ("win",), {"singing": F.col("label").isin("click", "purchase"), "speech": F.col("label") == "view"})
SQL["label_families"] = "SELECT user_id AS win, CAST(sum(CASE WHEN event_type IN ('click', 'purchase') THEN event_id ELSE 0 END) AS BIGINT) AS singing, CAST(sum(CASE WHEN event_type = 'view' THEN event_id ELSE 0 END) AS BIGINT) AS speech FROM events GROUP BY 1"


def _centers(s, d):
    base = table(s, d, "embeddings")
    first = base.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    return base.join(first, ["label", "vec_id"]).select(F.col("label").alias("character"), F.col("embedding").alias("center"))


Q["nearest_profile_margin"] = lambda s, d: vectors.nearest_profile(table(s, d, "embeddings").select("vec_id", "embedding"), _centers(s, d), "vec_id", 0.32, 0.03).select("vec_id", "character", F.round("distance", 5).alias("distance"), "sure")
SQL["nearest_profile_margin"] = sql(
    "SELECT vec_id, character, round(d, 5) AS distance, d <= 0.32 AND (d2 IS NULL OR d2 - d >= 0.03) AS sure FROM (SELECT *, lead(d) OVER w AS d2, row_number() OVER w AS n FROM (SELECT e.vec_id, c.label AS character, 1 - list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS d FROM embeddings e, c) WINDOW w AS (PARTITION BY vec_id ORDER BY d, character)) WHERE n = 1",
    c="SELECT label, embedding FROM embeddings WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)",
)

Q["evenly_spaced_sample"] = lambda s, d: vectors.evenly_spaced(table(s, d, "embeddings").select("label", "vec_id"), 7, ("label",), "vec_id")
SQL["evenly_spaced_sample"] = "SELECT label, vec_id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM embeddings) WHERE n <= 7 OR list_contains(list_transform(range(7), lambda j: round_even(j * (n - 1) / 6.0, 0)), CAST(i AS DOUBLE))"

Q["spherical_kmeans"] = lambda s, d: vectors.profile_centers(table(s, d, "embeddings").withColumn("seq", F.col("vec_id")), "label", 3, 10).select("label", "center_ix", F.round(F.element_at("center", 1), 4).alias("first"))


def _trimmed(s, d):
    import numpy as np

    centers = {str(r["character"]): np.array(r["center"]) for r in _centers(s, d).collect()}
    rows = table(s, d, "embeddings").select("label", "embedding", F.col("vec_id").alias("seq"), (F.col("vec_id") % 5 + 1).cast("double").alias("duration"))
    bounded = vectors.evenly_spaced(rows, 400, ("label",), "seq")
    return vectors.trimmed_distances(bounded, centers, ("label",)).select("label", "character", F.round("distance", 4).alias("distance"))


Q["medoid_trim_weighted"] = _trimmed

Q["leader_clusters"] = lambda s, d: ag.leader_clusters(cues(s, d).select("job", "text", (F.length("text") % 7 / 7.0).alias("score"), F.col("cue_id").alias("frame_ix"), F.col("s").alias("ts_us")), ("job",), 1)
Q["profile_upsert"] = lambda s, d: keyed.upsert_last(table(s, d, "embeddings").where("vec_id % 2 = 0").select("label", F.col("vec_id").alias("seq"), F.lit("m").alias("model")), table(s, d, "embeddings").where("vec_id % 2 = 1").select("label", F.col("vec_id").alias("seq"), F.lit("m").alias("model")), ("label",), "seq", 10)
SQL["profile_upsert"] = "SELECT label, vec_id AS seq, 'm' AS model FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id DESC) AS n FROM embeddings) WHERE n <= 10"

Q["current_results"] = lambda s, d: keyed.current(documents(s, d).select("doc_id", F.col("lang").alias("signature")), documents(s, d).where("doc_id % 3 = 0").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("old").alias("signature")), ("doc_id",))
SQL["current_results"] = "SELECT doc_id, lang AS signature FROM documents WHERE doc_id % 3 = 0 AND doc_id % 2 = 0"
