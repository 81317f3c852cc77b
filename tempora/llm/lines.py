"""Fuzzy line deduplication by MinHash, in DataFrame expressions only.

1. Equal lines are one from here on, known by a 128-bit hash. Every distinct line
   gets a MinHash signature of its character shingles, the same that step 3 compares;
   its 32 minima, of 15 bits each, make 8 bands. Shingles are rows, STEP of them in
   one, that a hash aggregate takes up without a shuffle of its own.
2. Lines that share a band meet its smallest line as candidates: a bucket of n lines
   makes n - 1 pairs, and its smallest line is aggregated before the shuffle.
   Candidates whose signatures differ in more than UNLIKE minima are none.
3. Candidates are verified by the exact Jaccard similarity of all their character
   shingles, and verified pairs joined to components by distributed union-find.
4. Lines of buckets that are not in one component meet again in sub-buckets, by two
   further minima for each of GROUPS groups. In sub-buckets of at most BUCKET_LINES
   lines all are compared across components; larger ones compare with their ends and
   are split again where several components stay. What LEVELS splits leave open is
   joined without loss by shingles: two similar lines share one of the rarest of each
   (prefix filter). So no pair is left out for the size of its bucket.
5. Of each component the occurrence with the smallest (doc_id, line number) stays.

With 8 bands of 4 a pair of similarity 0.8 shares a band with probability 0.985,
one of 0.9 with 0.99997; it passes the test of signatures with probability 0.998 and
meets in a sub-bucket with 0.998. A line or component that stands very often is
dealt to many tasks for the last joins.

Defined results: null and empty texts have no lines; blank lines are no lines
and stay; a document with a null doc_id keeps all its lines and removes none;
repeated rows are cut alike, since they hold the same occurrences.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.components import components, salted_join
from tempora.llm.textkit import id_and_text, materialise, read_table, release, scope

BANDS, ROWS = 8, 4
#: Bits that a signature holds of a minimum.
LANE = 15
SHINGLE_CHARS = 5
#: Shingles that one row takes up.
STEP = 8
#: Groups of two minima, beside a band, that sub-buckets go by.
GROUPS = 6
#: Lines of a sub-bucket that meet without a further split, and the splits of larger ones.
BUCKET_LINES, LEVELS = 1024, 2
#: Minima that similar lines differ in at most.
UNLIKE = 13
#: Cells in which shingles are counted for their order.
CELLS = 1 << 16
#: Line numbers that may be broadcast (8 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: A character that is not white space.
INK = r"[^\x20\x09-\x0D]"


def _masks() -> list[list[int]]:
    """Fixed 64-bit masks, ROWS for each band; x ^ mask permutes the hashes anew for each of them.

    The lowest value depends on the leading bits alone, so masks of one row differ in them.
    """
    found, state = [], 0x9E3779B97F4A7C15
    for band in range(BANDS):
        found.append([])
        for row in range(ROWS):
            state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
            turn = row % 3
            lead = (band << turn | band >> 3 - turn) & 7
            found[-1].append((lead << 61 | (state ^ state >> 29) & (1 << 61) - 1) - (1 << 63))
    return found


def _wide(line: Column) -> Column:
    """Four bytes a character, so that a shingle is found at its place."""
    return F.encode(line, "UTF-32")


def _last(wide: Column) -> Column:
    return F.greatest(F.floor(F.octet_length(wide) / 4).cast("int") - SHINGLE_CHARS, F.lit(0))


def _shingle(wide: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(wide, 4 * at + 1, F.lit(4 * SHINGLE_CHARS)))


def _shingles(line: Column) -> Column:
    # a lambda over one array keeps the line from being encoded once a shingle
    return F.array_distinct(F.transform(F.array(_wide(line)), lambda w: F.transform(F.sequence(F.lit(0), _last(w)), lambda at: _shingle(w, at)))[0])


def _signed(distinct: DataFrame) -> DataFrame:
    """The rows of distinct lines, with sig, a long for each band, in place of line; a line that is dealt by any of the columns stays where it is."""
    own = [c for c in distinct.columns if c != "line"]
    rows = distinct.select(*own, _wide(F.col("line")).alias("wide")).select(*own, "wide", _last(F.col("wide")).alias("last"))
    rows = rows.select(*own, "wide", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("begin"))
    # beyond the end the last shingle counts again, which changes no minimum
    rows = rows.select(*own, *(_shingle(F.col("wide"), F.least(F.col("begin") + i, F.col("last"))).alias(f"x{i}") for i in range(STEP)))
    turn = 64 // ROWS
    for r in range(1, ROWS):
        rows = rows.withColumns({f"x{i}_{r}": F.shiftleft(f"x{i}", turn * r).bitwiseOR(F.shiftrightunsigned(f"x{i}", 64 - turn * r)) for i in range(STEP)})
    masks = _masks()

    def low(band: int, row: int) -> Column:
        return F.min(F.least(*(F.col(f"x{i}_{row}" if row else f"x{i}").bitwiseXOR(F.lit(masks[band][row])) for i in range(STEP)))).alias(f"m{band}_{row}")

    rows = rows.groupBy(*own).agg(*(low(b, r) for b in range(BANDS) for r in range(ROWS)))
    packed = [F.lit(0).cast("long")] * BANDS
    for b in range(BANDS):
        for r in range(ROWS):
            packed[b] = packed[b].bitwiseOR(F.shiftleft(F.col(f"m{b}_{r}").bitwiseAND(F.lit((1 << LANE) - 1)), LANE * r))
    return rows.select(*own, F.array(*packed).alias("sig"))


def _unlike(x: Column, y: Column) -> Column:
    """The number of minima in which two signatures differ."""
    lanes = sum(1 << LANE * r for r in range(ROWS))
    low, high = lanes * ((1 << LANE - 1) - 1), lanes << LANE - 1
    total = F.lit(0)
    for b in range(BANDS):
        z = x[b].bitwiseXOR(y[b])
        # the highest bit of a lane is set where any of its bits differs; no lane overflows
        total = total + F.bit_count((z.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(z).bitwiseAND(F.lit(high)))
    return total


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, at (line number) and line of every line that is not blank."""
    rows = id_and_text(docs).where("doc_id is not null and text is not null")
    lines = rows.select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return lines.where(F.col("line").rlike(INK))


def _identity(line: Column) -> list[Column]:
    """128 bits."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(SHINGLE_CHARS), line).alias("k2")]


def _written(rows: DataFrame) -> DataFrame:
    """The rows as a written table; the shuffles behind it go, so that a step never stands on disk beside the one before."""
    table = materialise(rows)
    release(rows.sparkSession)
    return table


def line_table(found: DataFrame) -> DataFrame:
    """Every distinct line: id, k1, k2, doc_id and at (its smallest place), n (its occurrences) and sig; written once."""
    keyed = found.select("doc_id", "at", "line", *_identity(F.col("line")))
    # partitioned by k1 and k2 once, for both aggregates
    distinct = keyed.groupBy("k1", "k2").agg(F.first("line").alias("line"), F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n"))
    signed = _signed(distinct.select("k1", "k2", F.col("first.doc_id").alias("doc_id"), F.col("first.at").alias("at"), "n", "line"))
    return _written(signed.select(F.monotonically_increasing_id().alias("id"), "*"))


def _near(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most UNLIKE minima; written once."""
    sigs = table.select("id", "sig")
    both = pairs.distinct().join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("x")), "a").join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("y")), "b")
    return _written(both.where(_unlike(F.col("x"), F.col("y")) <= UNLIKE).select("a", "b"))


def _texts(ids: DataFrame, table: DataFrame, found: DataFrame) -> DataFrame:
    """id and line of the given ids, one row each; written once, so that later joins move no other text."""
    wanted = materialise(table.join(ids.distinct(), "id").select("id", "k1", "k2"))
    lines = found.select("line", *_identity(F.col("line")))
    lines = lines.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, ["k1", "k2"])
    # by the columns of the join, which has them together already
    return _written(lines.groupBy("k1", "k2").agg(F.first("id").alias("id"), F.first("line").alias("line")).select("id", "line"))


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), given as a written table, whose lines are similar."""
    first, second = texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), texts.select(F.col("id").alias("b"), F.col("line").alias("line_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", _shingles(F.col("line_a")).alias("x"), _shingles(F.col("line_b")).alias("y"))
    shared = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    return _written(shared.where(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("a", "b"))


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """The rows (bucket, id, component) of the buckets that hold several components; written once."""
    tied = components(links, "a", "b").withColumnRenamed("node", "id")
    rows = materialise(members.select("bucket", "id").join(tied, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component")))
    return _divided(rows).select("bucket", "id", "component")


def _divided(rows: DataFrame) -> DataFrame:
    """Of the rows (bucket, id, component) those of buckets with several components, with size, low and high of the bucket; written once."""
    sides = F.min("component").alias("c1"), F.max("component").alias("c2")
    several = rows.groupBy("bucket").agg(*sides, F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).where("c1 <> c2")
    return materialise(rows.join(several.drop("c1", "c2"), "bucket"))


def _sub_buckets(members: DataFrame, table: DataFrame, level: int) -> DataFrame:
    """(bucket, id, component) by the first bucket and two further minima, for each of GROUPS groups of two."""

    def minimum(j: int) -> Column:
        j = (j + level * GROUPS) % (BANDS * ROWS)
        return F.shiftright(F.col("sig")[j // ROWS], LANE * (j % ROWS)).bitwiseAND(F.lit((1 << LANE) - 1))

    rows = members.join(table.select("id", "sig"), "id")
    groups = F.array(*(F.xxhash64("bucket", F.lit(level * GROUPS + g), minimum(g), minimum(g + BANDS * ROWS // 2)) for g in range(GROUPS)))
    return rows.select("id", "component", F.explode(groups).alias("bucket")).select("bucket", "id", "component")


def _within(members: DataFrame, table: DataFrame) -> DataFrame:
    """Pairs (a, b) of like signatures and different components in sub-buckets of at most BUCKET_LINES lines; written once."""
    lines = members.select("bucket", "id", "component").join(table.select("id", "sig"), "id")
    x, y = (lines.select("bucket", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "component", "sig"))) for side in "ab")
    like = _unlike(F.col("sig_a"), F.col("sig_b")) <= UNLIKE
    pairs = x.join(y, "bucket").where((F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b")) & like)
    return _written(pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct())


def _rest(lines: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of lines (id, component) that may be similar and are in different components."""
    sets = materialise(texts.join(lines, "id")).select("id", "component", _shingles(F.col("line")).alias("x"))
    # rarest first: one order for all sets, by the size of a shingle's cell and its value, so no shingle travels to be counted
    cell = F.pmod(F.col("shingle"), F.lit(CELLS)).cast("int").alias("cell")
    sizes = bytearray(CELLS)
    for row in sets.select(F.explode("x").alias("shingle")).groupBy(cell).count().collect():  # at most CELLS rows
        sizes[row["cell"]] = min(255, int(8 * math.log2(1 + row["count"])))
    ordered = F.array_sort(F.transform("x", lambda h: F.struct(F.substring(F.lit(sizes), F.pmod(h, F.lit(CELLS)).cast("int") + 1, F.lit(1)).alias("often"), h.alias("shingle"))))
    # x finds y, not larger than x, by one of the first |x| - ceil(t |x|) + 1 of x and |y| - ceil(2 t / (1 + t) |y|) + 1 of y
    probe, index = (F.col("size") - F.expr(f"(size * {up} + {down} - 1) div {down}").cast("int") + 1 for up, down in ((percent, 100), (2 * percent, 100 + percent)))
    fronts = sets.select("id", "component", F.size("x").alias("size"), ordered.alias("x")).select("id", "component", "size", F.posexplode(F.slice("x", 1, probe)).alias("at", "s"))
    fronts = fronts.select(F.col("s.shingle").alias("shingle"), "component", F.struct("id", "size", (F.col("at") < index).alias("index")).alias("k"))
    # components meet, so no pair within one is made
    sides = fronts.repartition("shingle").groupBy("shingle", "component").agg(F.collect_list("k").alias("ids"))
    small = sides.select("shingle", F.col("component").alias("beyond"), F.filter("ids", lambda k: k["index"]).alias("others")).where(F.size("others") > 0)
    apart = sides.join(small, "shingle").where("component <> beyond").select(F.explode("ids").alias("k"), "others").select("k", F.explode("others").alias("o"))
    near = (F.col("k.size") >= F.col("o.size")) & (100 * F.col("o.size") >= percent * F.col("k.size"))
    return apart.where(near).select(F.least("k.id", "o.id").alias("a"), F.greatest("k.id", "o.id").alias("b"))


def similar_lines(table: DataFrame, found: DataFrame, percent: int = 80) -> DataFrame:
    """Verified pairs (a, b) of ids that join similar lines of a line_table of the lines found."""
    bands = F.array(*(F.xxhash64(F.lit(b), F.col("sig")[b]) for b in range(BANDS)))
    buckets = table.select("id", F.explode(bands).alias("bucket"))
    ends = buckets.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    met = _written(buckets.join(ends.select("bucket", "low"), "bucket"))
    texts = _texts(met.select("id"), table, found)
    links = _verified(_near(met.where("low <> id").select(F.col("low").alias("a"), F.col("id").alias("b")), table), texts, percent)
    members = _open(met, links)
    for level in range(LEVELS):
        split = _divided(_sub_buckets(members, table, level))
        small, large = (split.where(F.col("size") <= BUCKET_LINES), split.where(F.col("size") > BUCKET_LINES))
        ends = large.select("id", F.explode(F.array("low", "high")).alias("end")).where("id <> end")
        pairs = _near(ends.select(F.least("id", "end").alias("a"), F.greatest("id", "end").alias("b")), table)
        links = materialise(links.unionByName(_verified(_within(small, table).unionByName(pairs).distinct(), texts, percent)))
        if large.isEmpty():
            return links
        members = _open(large, links)
    return links.unionByName(_verified(_near(_rest(members.select("id", "component").distinct(), texts, percent), table), texts, percent))


def _kept_lines(found: DataFrame, percent: int) -> DataFrame:
    """k1, k2, kept (the place that stays) and n of lines of which an occurrence goes; written once."""
    table = line_table(found)
    tied = components(similar_lines(table, found, percent), "a", "b").withColumnRenamed("node", "id")
    place = F.struct("doc_id", "at")
    member = materialise(table.select("id", "k1", "k2", place.alias("own"), "n").join(tied, "id"))
    firsts = member.groupBy("component").agg(F.min("own").alias("kept"), F.count("*").alias("members"))
    near = salted_join(member, firsts, ["component"], "members", member.count(), "id").select("k1", "k2", "kept", "n")
    same = table.where("n > 1").join(tied, "id", "left_anti").select("k1", "k2", place.alias("kept"), "n")
    return materialise(near.unionByName(same), keep=True)


def removed_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id and the sorted numbers of the lines to remove, of documents that lose any."""
    found = occurrences(docs)
    with scope(docs.sparkSession):
        known = _kept_lines(found, percent)
    total = known.agg(F.sum("n").alias("n")).first()["n"] or 0
    place = F.struct("doc_id", "at")
    everywhere = found.select("doc_id", "at", *_identity(F.col("line")))
    gone = salted_join(everywhere, known, ["k1", "k2"], "n", total, "doc_id").where(place != F.col("kept"))
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("at")).alias("gone"))


def counted(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the numbers of the removed lines of every document."""
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(INK))).cast("long")
    rows = id_and_text(docs).select("doc_id", n_lines.alias("n_lines")).join(gone, "doc_id", "left")
    return rows.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("gone", F.array().cast("array<int>")).alias("removed"))


def deduplicate(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents with their columns, without the removed lines; those that lose every line go."""
    gone = removed_lines(docs, percent).select(F.col("doc_id").alias("lines gone from"), F.col("gone").alias("lines gone"))
    joined = docs.join(gone, docs["doc_id"].cast("long") == F.col("lines gone from"), "left")
    kept = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains("lines gone", at))
    text = F.when(F.col("lines gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    lost = F.col("lines gone").isNotNull() & ~F.exists(kept, lambda line: line.rlike(INK))
    return joined.where(~lost).withColumn("text", text).select(*docs.columns)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return counted(docs, removed_lines(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op5_line_dedup": op5_line_dedup}
