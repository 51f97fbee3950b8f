"""Reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybeat import constants as k
from tallybeat.operators.joins import fan_out_join
from tallybeat.operators.ranking import top


def total_revenue(unified: DataFrame) -> DataFrame:
    return unified.agg(F.sum("revenue_usd").alias("revenue_usd"))


def revenue_by_source(unified: DataFrame) -> DataFrame:
    return (
        unified.groupBy("source_type")
        .agg(F.sum("revenue_usd").alias("revenue_usd"))
        .orderBy(F.desc("revenue_usd"), "source_type")
    )


def partner_revenue_by_month(partner_revenue: DataFrame, month: str = "month_key") -> DataFrame:
    return (
        partner_revenue.groupBy(month)
        .agg(
            F.sum("streams").alias("total_streams"), F.sum("revenue_usd").alias("total_revenue")
        )
        .orderBy(month)
    )


def top_contributors(contributor_revenue: DataFrame, n: int = 10) -> DataFrame:
    """Highest allocated revenue; equal sums go by id."""
    totals = contributor_revenue.groupBy("contributor_id").agg(
        F.sum("allocated_revenue_usd").alias("total_allocated")
    )
    return top(totals, n, F.desc("total_allocated"), F.asc("contributor_id"))


def top_contributors_from_assets(unified: DataFrame, mapping: DataFrame, n: int = 10) -> DataFrame:
    """The same ranking straight from the unified fact.

    A contributor's share of an asset is the same in every period, so revenue is summed
    per asset before it is split: the fan-out then runs over assets, not asset periods.
    """
    per_asset = unified.groupBy("asset_id").agg(F.sum("revenue_usd").alias("revenue_usd"))
    shares = mapping.select("asset_id", "contributor_id", "allocation_percent")
    parts = fan_out_join(per_asset, shares, "asset_id", ["revenue_usd"], ["contributor_id"], most_rows=1).select(
        "contributor_id",
        (F.col("revenue_usd").cast(k.USD) * F.col("allocation_percent")).alias("allocated_revenue_usd"),
    )
    return top_contributors(parts, n)


def top_streams(stream_monthly: DataFrame, n: int = 10) -> DataFrame:
    """Months of recordings with the most streams; equal counts go by month and recording."""
    return top(
        stream_monthly, n, F.desc("stream_count"), F.asc("listen_month"), F.asc("recording_mbid")
    )


def table_totals(partner_revenue: DataFrame, views: DataFrame) -> DataFrame:
    """Whole-table sums of streams, original revenue and views, in one row."""
    sold = partner_revenue.select("streams", "revenue_original", F.lit(None).cast("bigint").alias("views"))
    seen = views.select(
        F.lit(None).cast("bigint").alias("streams"),
        F.lit(None).cast(sold.schema["revenue_original"].dataType).alias("revenue_original"),
        "views",
    )
    return sold.unionByName(seen).agg(
        F.sum("streams").alias("total_streams"),
        F.sum("revenue_original").alias("total_revenue_original"),
        F.sum("views").alias("total_views"),
    )


def contributors_per_asset(mapping: DataFrame) -> DataFrame:
    return mapping.agg(
        F.count("*").alias("mapping_rows"),
        F.countDistinct("asset_id").alias("assets"),
        (F.count("*") / F.countDistinct("asset_id")).alias("contributors_per_asset"),
    )
