"""Lookups in dictionaries, and matches between labels and text.

A dictionary is broadcast only while it has at most BROADCAST_ROWS rows; beyond
that the same join runs as a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a dictionary that may be broadcast.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The table, marked for broadcast if it is known to be small."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def resolve_identity(df: DataFrame, mapping: DataFrame, column: str, keys: Sequence[str] = ("job",)) -> DataFrame:
    """Replaces labels by the ones that mapping (anonymous, resolved, seq) gives; the last real one counts."""
    last = mapping.where(~F.col("anonymous").eqNullSafe(F.col("resolved"))).groupBy(*keys, "anonymous").agg(F.max_by("resolved", "seq").alias("_to"))
    met = df.join(last.withColumnRenamed("anonymous", column), [*keys, column], "left")
    return met.withColumn(column, F.coalesce("_to", column)).drop("_to").select(*df.columns)


def resolve_array(df: DataFrame, mapping: DataFrame, column: str, keys: Sequence[str] = ("job",)) -> DataFrame:
    """The same for an array of labels."""
    last = mapping.where(~F.col("anonymous").eqNullSafe(F.col("resolved"))).groupBy(*keys, "anonymous").agg(F.max_by("resolved", "seq").alias("_to"))
    table = last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("anonymous", "_to"))).alias("_map"))
    met = df.join(table, list(keys), "left")
    return met.withColumn(column, F.transform(column, lambda x: F.coalesce(F.try_element_at("_map", x), x))).select(*df.columns)


def resolve_alias(tokens: DataFrame, catalog: DataFrame, column: str) -> DataFrame:
    """Adds `canonical` and `heat`: of the entries that list a token as an alias, whatever its case, the hottest.

    catalog: canonical, heat, ord, aliases. Of equally hot ones the first; without any the token itself, heat 0.
    """
    names = catalog.select("canonical", "heat", "ord", F.explode(F.concat(F.array("canonical"), "aliases")).alias("alias"))
    best = names.groupBy(F.lower("alias").alias("_key")).agg(F.max_by(F.struct("canonical", "heat"), F.struct("heat", -F.col("ord"))).alias("_best"))
    met = tokens.withColumn("_key", F.lower(column)).join(small(best), "_key", "left")
    return met.withColumn("canonical", F.coalesce("_best.canonical", column)).withColumn("heat", F.coalesce("_best.heat", F.lit(0))).drop("_key", "_best")


def trigger(docs: DataFrame, glossary: DataFrame, text: Column) -> DataFrame:
    """Pairs of documents and glossary rows (name, always, match) that fire: always, or when the text holds a match."""
    lowered = docs.withColumn("_text", F.lower(text))
    fires = F.coalesce("always", F.lit(False)) | F.exists("match", lambda m: F.col("_text").contains(F.lower(m)))
    return lowered.join(small(glossary, 5000), fires).drop("_text")


def override(df: DataFrame, key: Sequence[str], value: str, order: str) -> DataFrame:
    """The value of the last load of each key."""
    return df.groupBy(*key).agg(F.max_by(value, order).alias(value))


def unique_entity(docs: DataFrame, aliases: DataFrame, text: Column, most: int = 100_000) -> DataFrame:
    """Adds `entity`: the only one of which an alias stands in the text; null if none or several.

    The dictionary of at most `most` aliases goes to every task as one array, so no
    text is shuffled and repeated rows stay; a longer one is an error.
    """
    if aliases.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} aliases")
    listed = aliases.select(F.col("entity").alias("e"), F.lower("alias").alias("a")).agg(F.collect_set(F.struct("e", "a")).alias("_listed"))
    met = docs.withColumn("_text", F.lower(text)).join(F.broadcast(listed))
    found = F.array_distinct(F.transform(F.filter("_listed", lambda x: F.col("_text").contains(x["a"])), lambda x: x["e"]))
    return met.withColumn("entity", F.when(F.size(found) == 1, found[0])).drop("_text", "_listed")


def latest_before(left: DataFrame, right: DataFrame, keys: Sequence[str], most: int, low: int, high: int) -> DataFrame:
    """Up to `most` last right rows that end in [s + low, s + high] of each left row, as an ordered array."""
    from pyspark.sql.window import Window

    other = right.select(*keys, F.col("rid").alias("r_rid"), F.col("e").alias("r_e"))
    met = left.join(other, [*(left[k] == other[k] for k in keys), F.col("r_e").between(F.col("s") + low, F.col("s") + high)])
    met = met.select(*(left[c] for c in left.columns), "r_rid", "r_e")
    rank = F.row_number().over(Window.partitionBy(*keys, "rid").orderBy(F.desc("r_e"), F.desc("r_rid")))
    return met.withColumn("_n", rank).where(F.col("_n") <= most).groupBy(*keys, "rid").agg(F.array_sort(F.collect_list(F.struct("r_e", "r_rid"))).alias("evidence"))
