"""Top rows, and a reproducible shuffle of a whole pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybeat.functions.seeded import digest


def top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows; every task keeps ``n`` rows, the data is never sorted as a whole."""
    return rows.orderBy(*order).limit(n)


def hash_rank(
    pool: DataFrame, key: str, seed: str, first: int | None = None, digits: int = 4
) -> DataFrame:
    """Number the pool 1..n in the order of a seeded digest of its unique key.

    A single ranking window would pull the pool into one task. Instead rows are counted
    per digest prefix (at most ``16 ** digits`` counts, 65,536 by default, which bounds
    both the running total and its broadcast), and ranked within their prefix. With
    ``first`` only prefixes that can hold a rank up to it are shuffled at all.
    """
    keyed = pool.withColumn("_digest", digest(seed, F.col(key))).withColumn(
        "_prefix", F.substring("_digest", 1, digits)
    )
    counts = keyed.groupBy("_prefix").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "_prefix", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    if first is not None:
        before = before.filter(F.col("_before") < first)
    within = F.row_number().over(Window.partitionBy("_prefix").orderBy("_digest", key))
    ranked = keyed.join(F.broadcast(before), "_prefix").withColumn(
        "rank", F.col("_before") + within
    )
    if first is not None:
        ranked = ranked.filter(F.col("rank") <= first)
    return ranked.drop("_digest", "_prefix", "_before")


def seeded_sample(pool: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``min(n, size)`` rows without replacement, the same ones on every run."""
    return hash_rank(pool, key, seed, first=n).drop("rank")
