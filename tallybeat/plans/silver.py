"""Specifications of the conformed tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybeat.constants import FX_RATE, MONEY, SHARE, USD, VIEW_RATE
from tallybeat.operators.conform import Field, TableSpec


def converted_amount() -> Column:
    """Amount in USD; without an exchange rate it is unknown, not zero."""
    return (F.col("revenue_original") * F.col("exchange_rate")).cast(USD)


def _plain(*names: str) -> tuple[Field, ...]:
    return tuple(Field(name) for name in names)


PLATFORMS = TableSpec(
    name="platforms",
    fields=(
        Field("platform_id"),
        Field("platform_name", trim=True),
        Field("platform_type", upper=True),
    ),
    key=("platform_id",),
    free_text=True,
)

DISTRIBUTORS = TableSpec(
    name="distributors",
    fields=(
        Field("distributor_id"),
        Field("distributor_name", trim=True),
        Field("payment_cycle"),
        Field("active_status", upper=True),
    ),
    key=("distributor_id",),
    free_text=True,
)

CONTRIBUTORS = TableSpec(
    name="contributors",
    fields=(
        Field("contributor_id"),
        Field("contributor_name", trim=True),
        Field("team", trim=True),
        Field("default_role", trim=True),
        Field("active_status", upper=True),
    ),
    key=("contributor_id",),
    free_text=True,
)

ARTISTS = TableSpec(
    name="artists",
    fields=(
        Field("artist_id"),
        Field("artist_name", trim=True),
        Field("distributor_id"),
        Field("label_name", trim=True),
        Field("project_name", trim=True),
        Field("active_status", upper=True),
        Field("created_date", "date"),
    ),
    key=("artist_id",),
    required=("artist_id",),
    free_text=True,
)

TRACKS = TableSpec(
    name="tracks",
    fields=(
        Field("track_id"),
        Field("track_title", trim=True),
        *_plain("asset_id", "isrc", "recording_mbid", "release_mbid"),
        Field("release_name", trim=True),
        *_plain("artist_id", "distributor_id"),
        Field("label_name", trim=True),
        Field("project_name", trim=True),
        Field("release_date", "date"),
        Field("active_status", upper=True),
    ),
    key=("track_id",),
    required=("track_id",),
    free_text=True,
)

CHANNELS = TableSpec(
    name="youtube_channels",
    fields=(
        Field("channel_id"),
        Field("channel_name", trim=True),
        Field("owner_team", trim=True),
        Field("created_date", "date"),
        Field("active_status", upper=True),
    ),
    key=("channel_id",),
    free_text=True,
)

VIDEOS = TableSpec(
    name="youtube_videos",
    fields=(
        Field("video_id"),
        Field("video_title", trim=True),
        *_plain("asset_id", "channel_id", "track_id"),
        Field("project_name", trim=True),
        Field("content_type", trim=True),
        Field("upload_date", "date"),
        Field("editor_code"),
    ),
    key=("video_id",),
    free_text=True,
)

# Views carry upper-case countries, so rates must too or they silently find no partner.
RATES = TableSpec(
    name="youtube_rate",
    fields=(
        Field("country", upper=True),
        Field("country_name", trim=True),
        Field("rate_per_view_usd", VIEW_RATE),
        Field("effective_from", "date"),
        Field("effective_to", "date"),
    ),
    key=("country",),
    order_by=("effective_from", "effective_to"),
    free_text=True,
)

#: The same with every period, for the join by validity.
RATE_PERIODS = replace(RATES, key=("country", "effective_from"), order_by=("effective_to",))

MAPPING = TableSpec(
    name="content_contributor_mapping",
    fields=(
        *_plain("asset_id", "contributor_id"),
        Field("role_in_asset", trim=True),
        Field("allocation_method", upper=True),
        Field("allocation_percent", SHARE),
    ),
    key=("asset_id", "contributor_id"),
    required=("asset_id", "contributor_id"),
)

VIEWS = TableSpec(
    name="youtube_view_daily",
    fields=(
        Field("view_date", "date"),
        Field("video_id"),
        Field("country", upper=True),
        Field("views", "bigint"),
    ),
    key=("view_date", "video_id", "country"),
    required=("video_id",),
    not_negative=("views",),
    partition_by="view_date",
)

PARTNER_REVENUE = TableSpec(
    name="distributor_revenue_monthly",
    fields=(
        *_plain("report_month", "distributor_id", "platform_id", "artist_id", "track_id"),
        Field("country", upper=True),
        Field("streams", "bigint"),
        Field("revenue_original", MONEY),
        Field("currency", upper=True),
        Field("exchange_rate", FX_RATE),
    ),
    key=("report_month", "distributor_id", "platform_id", "track_id", "country"),
    required=("track_id",),
    not_negative=("streams", "revenue_original"),
    derived={"revenue_usd": converted_amount},
    partition_by="report_month",
)

MASTERS = (
    PLATFORMS,
    DISTRIBUTORS,
    CONTRIBUTORS,
    ARTISTS,
    TRACKS,
    CHANNELS,
    VIDEOS,
    RATES,
    MAPPING,
)
TRANSACTIONS = (VIEWS, PARTNER_REVENUE)
STREAMS = "listenbrainz_stream_monthly"
