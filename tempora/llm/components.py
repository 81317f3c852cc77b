"""Connected components of a table of links: distributed union-find in DataFrame joins.

Rounds of large-star and small-star steps hang every node below the smallest
node it has seen. A round's links are written to the shared folder and read
again, so lineage stays short and a lost executor costs one round at most.
Minima are aggregated before the shuffle, and equal links after a large star are
one; a node with very many links splits among tasks as a skewed join. salted_join
does so for any join, by counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.textkit import materialise

#: A key with more than this share of all rows is dealt to several tasks; at most so many keys are.
SHARES = 1000


def salted_join(left: DataFrame, right: DataFrame, on: list[str], n: str, total: int, by: str) -> DataFrame:
    """left joined with right, which has one row a key and in n how many rows of left have that key.

    The sum of n is at most total. Rows of a key with more than total / SHARES rows,
    fewer than SHARES keys in all and so small enough to broadcast, are dealt by the
    column `by` among as many tasks as the key has shares.
    """
    copies = F.expr(f"({n} * {SHARES} div {max(1, total)}) + 1").cast("int")
    often = right.where(copies > 1).select(*on, copies.alias("salts"))
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(by), F.col("salts"))).cast("int")
    dealt = left.join(F.broadcast(often), on, "left").withColumn("salt", salt).drop("salts")
    held = right.withColumn("salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.join(held, [*on, "salt"]).drop("salt")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (the smallest node reachable) of every linked node."""
    pairs = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        pairs = materialise(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple:
    """Changes whenever the set of links does."""
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]
