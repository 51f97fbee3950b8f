"""One row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeat.functions.columns import minute_of


def keep_first(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    never_null: Sequence[str] = (),
) -> DataFrame:
    """The smallest row of every key, by ``order_by`` and then by all other columns.

    Unlike ``dropDuplicates`` the survivor does not depend on the order of the input. The
    minimum is taken before the shuffle too, so a key that holds a third of the table
    sends one row per task; a ranking window would sort all of them in one task. Null is
    a key like any other and sorts first among values.

    Rows are grouped by sorting. A hash of the key leads the sort, because whole numbers are
    radix-sorted while texts that start alike are compared one by one. A single further
    column that is ``never_null`` needs neither: its plain minimum is kept in a hash table.
    """
    rest = [c for c in rows.columns if c not in keys]
    ordered = [*(c for c in order_by if c in rest), *(c for c in rest if c not in order_by)]
    if not ordered:
        return rows.distinct()
    if len(ordered) == 1 and ordered[0] in never_null:
        return rows.groupBy(*keys).agg(F.min(ordered[0]).alias(ordered[0])).select(rows.columns)
    firsts = rows.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(
        F.min(F.struct(*ordered)).alias("_first")
    )
    return firsts.select(
        *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in rows.columns]
    )


def one_per_minute(
    listens: DataFrame,
    user: str = "user_id",
    recording: str = "recording_mbid",
    at: str = "listened_at",
) -> DataFrame:
    """Listens of one user to one recording within a minute count once, at the first instant."""
    return (
        listens.select(user, recording, minute_of(F.col(at)).alias("listen_minute"), at)
        .groupBy(user, recording, "listen_minute")
        .agg(F.min(at).alias(at))
    )


def first_seen(
    rows: DataFrame, key: str, position: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """For every non-blank key the ``keep`` columns of its first row in reading order."""
    return (
        rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        .groupBy(F.xxhash64(key).alias("_hash"), key)
        .agg(F.min(F.struct(*position, *keep)).alias("_first"))
        .select(key, *[F.col("_first")[c].alias(c) for c in keep])
    )


def flatten_lists(rows: DataFrame, lists: str, item: str, keep: Sequence[str]) -> DataFrame:
    """One row per different non-blank element of each list; empty lists vanish."""
    return rows.select(*keep, F.explode(F.array_distinct(lists)).alias(item)).filter(
        F.col(item).isNotNull() & (F.col(item) != "")
    )
