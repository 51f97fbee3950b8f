"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat.constants import ACTIVE, CALENDAR_END, CALENDAR_START, TRACK, VIDEO
from tallybeat.functions.columns import date_key, typed_null, weekend

# Dimension -> conformed table it repeats.
COPIES = {
    "dim_platform": "platforms",
    "dim_distributor": "distributors",
    "dim_contributor": "contributors",
    "dim_channel": "youtube_channels",
    "dim_artist": "artists",
}

ASSET_COLUMNS = (
    "asset_id asset_type asset_title video_id track_id recording_mbid release_mbid channel_id "
    "artist_id distributor_id project_name label_name release_date active_status"
).split()


def calendar_bounds(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """One row with the first and last day of the calendar."""
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    day = F.col("full_date")
    spine = bounds.select(
        F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("full_date")
    )
    return spine.select(
        date_key(day).alias("date_key"),
        "full_date",
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.date_format(day, "MMMM").alias("month_name"),
        weekend(day).alias("is_weekend"),
    )


def dim_content_asset(videos: DataFrame, tracks: DataFrame) -> DataFrame:
    """Videos and tracks as one list of assets; what one kind lacks is null."""
    video_assets = videos.select(
        "asset_id",
        F.lit(VIDEO).alias("asset_type"),
        F.col("video_title").alias("asset_title"),
        "video_id",
        "channel_id",
        "project_name",
        F.col("upload_date").alias("release_date"),
        F.lit(ACTIVE).alias("active_status"),
    )
    track_assets = tracks.select(
        "asset_id",
        F.lit(TRACK).alias("asset_type"),
        F.col("track_title").alias("asset_title"),
        *("track_id recording_mbid release_mbid artist_id distributor_id".split()),
        *("project_name label_name release_date active_status".split()),
    )
    return _complete(video_assets).unionByName(_complete(track_assets))


def _complete(assets: DataFrame) -> DataFrame:
    return assets.select(
        *[
            F.col(name) if name in assets.columns else typed_null("string").alias(name)
            for name in ASSET_COLUMNS
        ]
    )
