"""Readers and writers of subtitles and of versioned JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.functions.text import CJK, without_final_punctuation
from tempora.functions.time import ass_time, from_srt_time, srt_time

TIMING = r"(\d{1,3}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{1,3}:\d{2}:\d{2}[,.]\d{3})"
CUE = "struct<start_us:bigint,end_us:bigint,text:string,speaker:string,kind:string,boundary_hint:string>"
SIDECAR_VERSION = 3


def parse_subtitles(files: DataFrame, keys: Sequence[str] = ("job",)) -> DataFrame:
    """Cues of whole SubRip or WebVTT texts (column `text`): keys, cue_id, start_us, end_us, text.

    A block without a timing line is no cue; tags go, and cues left empty go.
    """
    clean = F.regexp_replace(F.regexp_replace("text", "^\\x{feff}", ""), "\r\n?", "\n")
    blocks = files.select(*keys, F.posexplode(F.split(clean, r"\n\s*\n")).alias("at", "block"))
    timed = blocks.where(F.col("block").rlike(TIMING))
    start, end = (F.regexp_extract("block", TIMING, i) for i in (1, 2))
    body = F.regexp_extract("block", rf"(?s)^.*?{TIMING}[^\n]*\n?(.*)$", 3)
    text = F.trim(F.regexp_replace(body, "<[^>]+>", ""))
    found = timed.select(*keys, "at", from_srt_time(start).alias("start_us"), from_srt_time(end).alias("end_us"), F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).alias("text")).where("text <> ''")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("at")) - 1
    return found.withColumn("cue_id", number.cast("long")).select(*keys, "cue_id", "start_us", "end_us", "text")


def read_subtitles(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Cues of all files below a path; job is the file's path. strict: a file without cues is an error."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("job"), F.col("value").alias("text"))
    found = parse_subtitles(files)
    if not strict:
        return found
    counts = files.select("job").join(found.groupBy("job").agg(F.count("*").alias("n")), "job", "left")
    checked = counts.select("job", F.assert_true(F.coalesce("n", F.lit(0)) > 0, F.concat(F.lit("no cues in "), F.col("job"))).alias("_ok"))
    return found.join(checked, "job").where("_ok is null").drop("_ok")


def srt_blocks(cues: DataFrame, keys: Sequence[str] = ("job",)) -> DataFrame:
    """One SubRip text for each timeline; indices from 1 without gaps. Columns start_us, end_us, text."""
    row = F.struct("start_us", "end_us", "cue_id", "text")
    ordered = cues.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def block(c: Column, i: Column) -> Column:
        return F.concat((i + 1).cast("string"), F.lit("\n"), srt_time(c["start_us"]), F.lit(" --> "), srt_time(c["end_us"]), F.lit("\n"), F.trim(c["text"]))

    return ordered.select(*keys, F.concat(F.array_join(F.transform("rows", block), "\n\n"), F.lit("\n")).alias("text"))


def write_srt(cues: DataFrame, path: str) -> None:
    """A folder a timeline, with its SubRip text."""
    srt_blocks(cues).repartition("job").write.mode("overwrite").partitionBy("job").text(path, lineSep="")


def ass_events(cues: DataFrame, style: Column | None = None) -> DataFrame:
    """Dialogue lines of cues with lanes; empty intervals have none. Columns s, e, lane, speaker, text."""
    name = style if style is not None else F.coalesce("speaker", F.lit("Default"))
    text = F.replace(without_final_punctuation(F.col("text")), F.lit("\n"), F.lit(r"\N"))
    line = F.concat(F.lit("Dialogue: "), F.col("lane").cast("string"), F.lit(","), ass_time(F.col("s")), F.lit(","), ass_time(F.col("e")), F.lit(","), name, F.lit(",,0,0,0,,"), text)
    return cues.where("e > s").withColumn("line", line)


def ass_colour(rgb: Column) -> Column:
    """RRGGBB as &H00BBGGRR."""
    return F.concat(F.lit("&H00"), F.substring(rgb, 5, 2), F.substring(rgb, 3, 2), F.substring(rgb, 1, 2))


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Cues of versioned JSON documents; another version is an error."""
    rows = spark.read.schema(f"version int, cues array<{CUE}>").json(path, multiLine=True).select(F.col("_metadata.file_path").alias("job"), "version", "cues")
    checked = rows.withColumn("_ok", F.assert_true(F.col("version") == SIDECAR_VERSION, F.concat(F.lit("unsupported version in "), F.col("job")))).where("_ok is null")
    return checked.select("job", F.posexplode("cues").alias("cue_id", "cue")).select("job", F.col("cue_id").cast("long").alias("cue_id"), "cue.*")


def write_sidecar(cues: DataFrame, path: str) -> None:
    row = F.struct("cue_id", "start_us", "end_us", "text", "speaker", "kind", "boundary_hint")
    ordered = cues.groupBy("job").agg(F.array_sort(F.collect_list(row)).alias("cues"))
    ordered.select("job", F.lit(SIDECAR_VERSION).alias("version"), "cues").write.mode("overwrite").partitionBy("job").json(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """key and value of a JSON object of lists or scalars."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """canonical, heat, ord, aliases of a JSON object {canonical: {heat, aliases}}."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,struct<heat:int,aliases:array<string>>>").alias("m"))
    return rows.select(F.posexplode(F.map_entries("m")).alias("ord", "x")).select(F.col("x.key").alias("canonical"), F.coalesce("x.value.heat", F.lit(0)).alias("heat"), "ord", F.coalesce("x.value.aliases", F.array().cast("array<string>")).alias("aliases"))


def read_profiles(spark: SparkSession, path: str, model: str) -> DataFrame:
    """character, seq, embedding of profile documents of one model; others and malformed ones are skipped."""
    rows = spark.read.schema("version int, character_id string, model string, embeddings array<array<float>>, _corrupt_record string").json(path, multiLine=True)
    good = rows.where((F.col("model") == model) & (F.size("embeddings") > 0) & F.forall("embeddings", lambda e: F.size(e) > 0))
    return good.select(F.col("character_id").alias("character"), F.posexplode("embeddings").alias("seq", "embedding"))


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored results, or none where nothing readable is stored: a miss is never an error."""
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    except Exception:  # noqa: BLE001  the path may not exist yet
        return spark.createDataFrame([], schema)


def write_state(df: DataFrame, path: str, partition: str = "job") -> None:
    """Replaces the partitions that the table holds; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def append_audit(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def manifest(df: DataFrame) -> DataFrame:
    """One JSON document a row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("document"))


def frame_times(spans: DataFrame, every_us: int) -> DataFrame:
    """Times at fixed distances in [s, e]."""
    return spans.withColumn("ts_us", F.explode(F.sequence("s", "e", F.lit(every_us))))


def marked_section(text: Column, name: str) -> Column:
    """What stands between <!-- NAME_START --> and <!-- NAME_END -->."""
    return F.trim(F.regexp_extract(text, rf"(?s)<!--\s*{name}_START\s*-->(.*?)<!--\s*{name}_END\s*-->", 1))


def unknown_placeholders(text: Column, known: Sequence[str]) -> Column:
    """Placeholders {{name}} of a template that are not among the known ones."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\{\{(\w+)\}\}"), F.lit(1))), F.array(*map(F.lit, known)))


def parse_segments(text: Column) -> Column:
    """[t][S01]words[t] as an array of (start, speaker, text, end), empty and reversed ones dropped."""
    pattern = r"\[(\d+(?:\.\d+)?)\]\[(S\d+)\](.*?)\[(\d+(?:\.\d+)?)\]"
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (1, 2, 3, 4)]
    rows = F.arrays_zip(*(p.alias(n) for p, n in zip(parts, ("a", "b", "c", "d"), strict=True)))
    shaped = F.transform(rows, lambda r: F.struct((r["0"].cast("double") * 1_000_000).cast("long").alias("start_us"), r["1"].alias("speaker"), F.trim(r["2"]).alias("text"), (r["3"].cast("double") * 1_000_000).cast("long").alias("end_us")))
    return F.filter(shaped, lambda r: (r["text"] != "") & (r["end_us"] > r["start_us"]))


def cjk_edge(text: Column) -> Column:
    return text.rlike(f"[{CJK}]$")
