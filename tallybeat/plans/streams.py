"""Listen events to monthly streams and listeners."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeat.constants import ACTIVE
from tallybeat.functions.columns import minute_of, month_key
from tallybeat.operators.joins import broadcasts, keep_members, small_or_merged
from tallybeat.sources.tables import staged

CATALOG = ["recording_mbid", "asset_id", "artist_id", "distributor_id"]


def active_catalog(tracks: DataFrame) -> DataFrame:
    """The active tracks; a track is known to the events by its recording id."""
    return tracks.filter(F.col("active_status") == ACTIVE).select(
        F.col("track_id").alias("recording_mbid"), "asset_id", "artist_id", "distributor_id"
    )


#: Parts of a recording's users that are joined with the catalog apart.
SALTS = 16


def active_listens(listens: DataFrame, catalog: DataFrame) -> DataFrame:
    """Listens to the tracks of the active catalog, cut to what counting needs.

    A small catalog, by a count, is broadcast as it is. A larger one is joined on the recording and
    a part of its users, so a recording with very many listens is met by ``SALTS`` tasks; the
    narrow catalog is repeated as often, and never sent to the driver. That partitioning does not
    serve the counts after it, which deal the rows anew by user.
    """
    known = listens.filter(F.col("recording_mbid").isNotNull()).select(
        "user_id", "recording_mbid", "listened_at"
    )
    members = catalog.select("recording_mbid").distinct()
    if broadcasts(catalog):
        return known.join(F.broadcast(members), "recording_mbid", "left_semi")
    repeated = members.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = known.withColumn("_salt", F.pmod(F.xxhash64("user_id"), F.lit(SALTS)).cast("int"))
    return salted.join(repeated.hint("merge"), ["recording_mbid", "_salt"], "left_semi").drop("_salt")


def stream_monthly(listens: DataFrame, tracks: DataFrame) -> DataFrame:
    """Streams and unique listeners per month and active track.

    A user's listens to a recording count once a minute. Events meet the catalog before
    anything is shuffled, and only three narrow columns travel: month, recording and the
    counts decide nothing about asset, artist and distributor, so those are added to the
    few result rows at the end. Every shuffle is keyed by user, or a part of the users, as
    well as recording or follows a partial count, so a recording with a third of all
    listens stays spread out. The catalog is staged, so it is conformed once.
    """
    catalog = staged(active_catalog(tracks), "active-catalog")
    per_minute = (
        active_listens(listens, catalog)
        .select("user_id", "recording_mbid", minute_of(F.col("listened_at")).alias("listen_minute"))
        .distinct()
    )
    counts = (
        per_minute.withColumn("listen_month", month_key(F.col("listen_minute")))
        .groupBy("listen_month", "recording_mbid")
        .agg(
            F.count("*").alias("stream_count"),
            F.countDistinct("user_id").alias("unique_listeners"),
        )
    )
    return counts.join(small_or_merged(catalog), "recording_mbid").select(
        "listen_month", *CATALOG, "stream_count", "unique_listeners"
    )


def active_members(listens: DataFrame, tracks: DataFrame) -> DataFrame:
    """Size of the active catalog and how much of it was ever listened to."""
    active = staged(active_catalog(tracks).select("recording_mbid").distinct(), "active-recordings")
    of_active = keep_members(listens.select("recording_mbid"), small_or_merged(active), "recording_mbid")
    heard = of_active.distinct().withColumn("heard", F.lit(1))
    return active.join(heard, "recording_mbid", "left").agg(
        F.count("*").alias("active_tracks"), F.count("heard").alias("heard_tracks")
    )
