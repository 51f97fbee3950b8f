"""Equi-joins in the forms the jobs need.

A table whose size depends on the data is marked for broadcast only after a count of its rows
(``small_side``). Otherwise Spark
broadcasts a side below ``spark.sql.autoBroadcastJoinThreshold`` by itself, from file
statistics or from the measured size of a finished stage, and otherwise sorts and merges,
splitting hot partitions (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybeat.sources.tables import staged


def keep_members(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``members``; the set stays distributed."""
    return rows.join(members.select(key), key, "left_semi")


def keep_strangers(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``members``."""
    return rows.join(members.select(key), key, "left_anti")


def lookup(rows: DataFrame, table: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Add the ``values`` of the matching row of ``table``; rows without one are dropped."""
    return rows.join(table.select(key, *values), key, "inner")


#: Rows up to which a counted side is broadcast, and days of a bucket beyond.
SMALL, BUCKET = 50_000, 32


def is_small(table: DataFrame, most: int = SMALL) -> bool:
    """Whether a table has at most ``most`` rows; counting stops there."""
    return table.limit(most + 1).count() <= most


def small_side(table: DataFrame, most: int = SMALL) -> DataFrame:
    """A table marked for broadcast if a count shows it is small; else Spark decides."""
    return F.broadcast(table) if is_small(table, most) else table


def broadcasts(table: DataFrame, most: int = SMALL) -> bool:
    """Whether a side may be broadcast: a count shows it is small, and broadcasts are not off."""
    off = str(table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).startswith("-")
    return not off and is_small(table, most)


def small_or_merged(table: DataFrame, most: int = SMALL) -> DataFrame:
    """A side marked for broadcast if a count shows it is small, else for a merge.

    Left alone, Spark judges a side by the bytes of its files, which say little about its rows: a
    million short ones pass for a few megabytes and would be gathered in the driver. The side is
    counted, then read again: hand over a table or a staged result.
    """
    return F.broadcast(table) if broadcasts(table, most) else table.hint("merge")


def in_force(periods: DataFrame, on: str, start: str, end: str) -> DataFrame:
    """Periods cut so that on every day at most one of a key is in force: of those begun, the last.

    A period ends with its own end (null: never) or on the day before the next one of its key
    begins. A null start is before all others. Of periods of one key and start the longest stays, then
    the largest by its other columns. Those that end before they begin go.
    """
    others = sorted(c for c in periods.columns if c not in (on, start, end))
    longest = F.struct(F.col(end).isNull().alias("open"), F.col(end).alias("end"), *others)
    one = periods.filter(F.col(start).isNull() | F.col(end).isNull() | (F.col(start) <= F.col(end)))
    one = one.groupBy(on, start).agg(F.max(longest).alias("_kept"))
    following = F.lead(start).over(Window.partitionBy(on).orderBy(F.asc_nulls_first(start)))
    return one.select(
        on, start, F.least(F.col("_kept.end"), F.date_sub(following, 1)).alias(end), *[F.col(f"_kept.{c}") for c in others]
    )


def valid_at(
    rows: DataFrame, periods: DataFrame, on: str, day: str, start: str, end: str, most: int = SMALL
) -> DataFrame:
    """Left join of rows with the period of their key in force on their day; one row each.

    Periods go through ``in_force``. Few of them, by a count, are broadcast. More are met in buckets of
    days: a period lies in every bucket that it touches between the first and last day of the
    rows, so rows and periods meet by key and bucket and only the days within are compared.
    """
    valid = in_force(periods, on, start, end)
    covers = (F.col(start).isNull() | (F.col(day) >= F.col(start))) & (F.col(end).isNull() | (F.col(day) <= F.col(end)))
    values = [c for c in valid.columns if c != on]
    named = valid.select(F.col(on).alias("_on"), *values)
    same = F.col(on) == F.col("_on")
    if is_small(periods, most):
        return rows.join(F.broadcast(named), same & covers, "left").select(*rows.columns, *values)
    first, last = (rows.select(of(day)).scalar() for of in (F.min, F.max))
    bucket = lambda d: F.floor(F.unix_date(d) / F.lit(BUCKET))
    low, high = bucket(F.greatest(F.col(start), first)), bucket(F.least(F.col(end), last))
    buckets = F.when(low <= high, F.sequence(low, high))
    cut = named.select("*", F.explode(buckets).alias("_bucket"))
    placed = rows.withColumn("_day_bucket", bucket(F.col(day)))
    met = placed.join(cut, same & (F.col("_day_bucket") == F.col("_bucket")) & covers, "left")
    return met.select(*rows.columns, *values)


#: Rows that one task may make of one key.
TILE = 1 << 22


def fan_out_grid(
    rows: DataFrame, details: DataFrame, on: str, tile: int = TILE, most_rows: int | None = None
) -> DataFrame:
    """Keys whose output is longer than a tile, with the parts to cut their rows and details into.

    The output of a key with n rows and m details is a rectangle of n x m. It is cut into tiles: the
    longer side into as many parts as the output has tiles, the shorter one only where it is longer
    than the side of a square tile by itself. A side is repeated once per part of the other, so the
    longer side stays as it is unless both are long. There are at most as many such keys as the
    output has tiles. With ``most_rows``, a bound on n known beforehand, rows are not counted.
    """
    sizes = details.groupBy(on).agg(F.count("*").alias("_m"))
    if most_rows is None:
        sizes = sizes.join(rows.groupBy(on).agg(F.count("*").alias("_n")), on)
    else:
        sizes = sizes.withColumn("_n", F.lit(most_rows).cast("bigint"))
    output = F.col("_n").cast("double") * F.col("_m")
    short = F.ceil(F.least("_n", "_m") / F.lit(float(tile) ** 0.5))
    long = F.ceil(output / tile / short)
    by_rows = F.col("_n") >= F.col("_m")
    return sizes.filter(output > tile).select(
        on,
        F.when(by_rows, long).otherwise(short).cast("int").alias("_row_parts"),
        F.when(by_rows, short).otherwise(long).cast("int").alias("_detail_parts"),
    )


def fan_out_join(
    rows: DataFrame,
    details: DataFrame,
    on: str,
    rows_by: Sequence[str],
    details_by: Sequence[str],
    tile: int = TILE,
    most_rows: int | None = None,
) -> DataFrame:
    """Inner n:m join in which no task expands more than a tile of one key.

    The cost of a fan-out is its output: a key with few rows on one side and millions on the
    other looks small to size-based skew handling. So keys are counted on both sides first, and
    those with a long output are cut by ``fan_out_grid``; parts are drawn by a hash of ``rows_by`` and
    ``details_by``. Where no key is long, which the counts tell, it is a plain join; and a
    side that no part of the other asks to repeat is not expanded before its shuffle. What is
    counted is read twice: hand over tables or staged results, or ``most_rows`` if the rows per key
    have a known bound.
    """
    grid = staged(fan_out_grid(rows, details, on, tile, most_rows), "fan-out-grid")
    most = grid.agg(F.max("_row_parts").alias("rows"), F.max("_detail_parts").alias("details")).first()
    if most.rows is None:
        return rows.join(details, on, "inner")

    def dealt(side: DataFrame, by: Sequence[str], own: str, other: str, copies: int) -> DataFrame:
        parts = side.join(grid, on, "left")
        one = F.lit(1)
        place = F.pmod(F.xxhash64(*by), F.coalesce(f"_{own}_parts", one)).cast("int")
        others = F.sequence(F.lit(0), F.coalesce(f"_{other}_parts", one) - 1)
        return parts.select(
            *side.columns,
            place.alias(f"_{own}"),
            (F.explode(others) if copies > 1 else F.lit(0)).alias(f"_{other}"),
        )

    left = dealt(rows, rows_by, "row", "detail", most.details)
    right = dealt(details, details_by, "detail", "row", most.rows)
    return left.join(right, [on, "_row", "_detail"], "inner").drop("_row", "_detail")
