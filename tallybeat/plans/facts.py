"""Facts of the star schema.

Fact rows meet their dimension on its unique key, so a hot country, video or track makes a
large partition on the fact side only, which adaptive execution splits when the dimension
is too large to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeat import constants as k
from tallybeat.functions.columns import date_key, typed_null
from tallybeat.operators.conform import REASON
from tallybeat.operators.joins import TILE, fan_out_join, lookup, small_side, valid_at

#: An asset has a row per day or month: more than the days of a century it cannot have.
PERIODS_PER_ASSET = 36_525
PERIOD = ["revenue_period", "period_type", "source_type", "asset_id"]


RATE = ["rate_per_view_usd"]
TOO_LARGE = "youtube_revenue_usd out of range"


def _priced(views: DataFrame, rates: DataFrame, videos: DataFrame, by_validity: bool) -> DataFrame:
    """Views with their asset and rate; ``_refused`` marks amounts that the money type cannot hold.

    Rates meet the views first, where they are broadcast if a count shows they are few, so only
    the video shuffles the views.
    """
    if by_validity:
        priced = valid_at(views, rates, "country", "view_date", "effective_from", "effective_to")
    else:
        priced = views.join(small_side(rates.select("country", *RATE)), "country", "left")
    assets = videos.filter(F.col("asset_id").isNotNull())
    product = F.col("views") * F.col(RATE[0])
    amount = product.try_cast(k.USD)
    return lookup(priced, assets, "video_id", ["asset_id", "channel_id"]).select(
        date_key(F.col("view_date")).alias("date_key"),
        "asset_id",
        "video_id",
        "channel_id",
        "country",
        "views",
        *RATE,
        amount.alias("youtube_revenue_usd"),
        (amount.isNull() & F.col("views").isNotNull() & F.col(RATE[0]).isNotNull()).alias("_refused"),
    )


def view_revenue_daily(
    views: DataFrame, rates: DataFrame, videos: DataFrame, by_validity: bool = False
) -> DataFrame:
    """Views times the rate of their country.

    A country without a rate keeps its views with unknown revenue; a view of a video that
    is not in the catalog, or has no asset, is left out. A row whose amount the money type cannot
    hold does not stop the others; ``view_revenue_rejects`` lists it. By default a country has one
    rate; with ``by_validity`` rates are periods, and the one in force on the day counts.
    """
    return _priced(views, rates, videos, by_validity).filter(~F.col("_refused")).drop("_refused")


def view_revenue_rejects(
    views: DataFrame, rates: DataFrame, videos: DataFrame, by_validity: bool = False
) -> DataFrame:
    """The rows that ``view_revenue_daily`` refuses, with the reason."""
    refused = _priced(views, rates, videos, by_validity).filter("_refused").drop("_refused", "youtube_revenue_usd")
    return refused.withColumn(REASON, F.lit(TOO_LARGE))


def partner_revenue_monthly(revenue: DataFrame, tracks: DataFrame) -> DataFrame:
    """Reported revenue with the asset of its track; unknown tracks are left out."""
    assets = tracks.filter(F.col("asset_id").isNotNull())
    return lookup(revenue, assets, "track_id", ["asset_id"]).select(
        F.col("report_month").alias("month_key"),
        *("asset_id track_id artist_id distributor_id platform_id country streams".split()),
        *("revenue_original currency exchange_rate revenue_usd".split()),
    )


def revenue_unified(view_revenue: DataFrame, partner_revenue: DataFrame) -> DataFrame:
    """Both facts in one shape; days and months share a text column told apart by its type."""
    by_view = view_revenue.select(
        F.col("date_key").cast("string").alias("revenue_period"),
        F.lit(k.DAILY).alias("period_type"),
        F.lit(k.YOUTUBE).alias("source_type"),
        "asset_id",
        F.lit(k.VIDEO).alias("asset_type"),
        F.lit(k.VIEW_PLATFORM).alias("platform_id"),
        typed_null("string").alias("distributor_id"),
        "country",
        "views",
        typed_null("bigint").alias("streams"),
        F.col("youtube_revenue_usd").alias("revenue_usd"),
    )
    by_partner = partner_revenue.select(
        F.col("month_key").alias("revenue_period"),
        F.lit(k.MONTHLY).alias("period_type"),
        F.lit(k.DISTRIBUTOR).alias("source_type"),
        "asset_id",
        F.lit(k.TRACK).alias("asset_type"),
        "platform_id",
        "distributor_id",
        "country",
        typed_null("bigint").alias("views"),
        "streams",
        "revenue_usd",
    )
    return by_view.unionByName(by_partner)


def asset_revenue(unified: DataFrame) -> DataFrame:
    """Revenue per period, source and asset; unknown when no row of the group has an amount."""
    return unified.groupBy(*PERIOD).agg(F.sum("revenue_usd").alias("revenue_usd"))


def contributor_revenue(assets: DataFrame, mapping: DataFrame, tile: int = TILE) -> DataFrame:
    """Each contributor's part of the revenue of the assets they worked on.

    Parts follow the stored percentages as they are, also where these do not add up to 1.
    ``assets`` is the result of ``asset_revenue``, one row per asset and period however many sales
    went into it, so its rows per asset have a bound and only the mapping is counted.
    """
    shares = mapping.select("asset_id", "contributor_id", "role_in_asset", "allocation_percent")
    periods = [c for c in PERIOD if c != "asset_id"]
    joined = fan_out_join(assets, shares, "asset_id", periods, ["contributor_id"], tile, PERIODS_PER_ASSET)
    return joined.select(
        *PERIOD,
        "contributor_id",
        "role_in_asset",
        "revenue_usd",
        "allocation_percent",
        (F.col("revenue_usd").cast(k.USD) * F.col("allocation_percent")).alias("allocated_revenue_usd"),
    )
