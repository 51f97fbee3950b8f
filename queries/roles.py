"""The test tables in the roles of the media business.

part = track (and, except PROMO parts, video), p_brand = artist, supplier = distributor,
supplier nation = channel, l_returnflag = platform, nation = country, events = listens,
lineitem by ship date = daily views, lineitem with its order = partner revenue.
The raw frames keep gaps, bad dates, padding, mixed case, refunds and unknown ids, made by
rules over the given columns, so that conforming has something to do.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat.operators.conform import conform
from tallybeat.plans import facts, silver, synth
from tallybeat.sources.tables import staged


def cache(make: Callable) -> Callable:
    """Make a frame once per object; it goes with the object."""

    @wraps(make)
    def kept(self, *args):
        frames = self.__dict__.setdefault("_frames", {})
        key = (make.__name__, *args)
        if key not in frames:
            frames[key] = make(self, *args)
        return frames[key]

    return kept


class Roles:
    """Raw and conformed frames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cache
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # raw ---------------------------------------------------------------------------------

    def raw_distributors(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("distributor_id"),
            F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("distributor_name"),
            F.when(F.col("s_nationkey") % 2 == 0, "Monthly").otherwise("Weekly").alias("payment_cycle"),
            F.when(F.col("s_acctbal") > 0, "active").otherwise("inactive").alias("active_status"),
        )

    def raw_channels(self) -> DataFrame:
        """A row per supplier, so a nation's key comes many times."""
        day = F.format_string("2020-%02d-%02d", F.pmod("s_suppkey", F.lit(14)), F.pmod("s_suppkey", F.lit(28)) + 1)
        return self.table("supplier").select(
            F.col("s_nationkey").alias("channel_id"),
            F.concat(F.lit(" "), "s_name").alias("channel_name"),
            F.concat(F.lit("team "), F.pmod("s_suppkey", F.lit(5)).cast("string"), F.lit(" ")).alias("owner_team"),
            day.alias("created_date"),
            F.lit("active").alias("active_status"),
        )

    def raw_artists(self) -> DataFrame:
        """A row per part; parts of size 1 lack the artist id."""
        return self.table("part").select(
            F.when(F.col("p_size") != 1, F.col("p_brand")).alias("artist_id"),
            F.concat(F.lit("  "), "p_name").alias("artist_name"),
            F.pmod("p_partkey", F.lit(7)).alias("distributor_id"),
            F.concat("p_type", F.lit(" ")).alias("label_name"),
            F.col("p_type").alias("project_name"),
            F.lower("p_type").alias("active_status"),
            F.format_string("2021-%02d-15", F.pmod("p_size", F.lit(15))).alias("created_date"),
        )

    def raw_tracks(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("track_id"),
            F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("track_title"),
            F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("asset_id"),
            F.concat(F.lit("XX-"), F.col("p_size").cast("string")).alias("isrc"),
            F.col("p_partkey").alias("recording_mbid"),
            F.col("p_brand").alias("release_mbid"),
            F.concat("p_brand", F.lit("  ")).alias("release_name"),
            F.col("p_brand").alias("artist_id"),
            F.pmod("p_partkey", F.lit(7)).alias("distributor_id"),
            F.col("p_type").alias("label_name"),
            F.col("p_name").alias("project_name"),
            F.format_string("2022-%02d-%02d", F.pmod("p_size", F.lit(13)), F.pmod("p_size", F.lit(28)) + 1).alias(
                "release_date"
            ),
            F.when(F.col("p_type") == "PROMO", "inactive").otherwise("active").alias("active_status"),
        )

    def raw_videos(self) -> DataFrame:
        key = F.col("p_partkey").cast("string")
        return (
            self.table("part")
            .filter(F.col("p_type") != "PROMO")
            .select(
                F.concat(F.lit("VID"), key).alias("video_id"),
                F.concat(F.lit(" "), "p_name").alias("video_title"),
                F.concat(F.lit("V"), key).alias("asset_id"),
                F.pmod("p_partkey", F.lit(25)).alias("channel_id"),
                F.col("p_partkey").alias("track_id"),
                F.col("p_name").alias("project_name"),
                F.concat("p_type", F.lit(" ")).alias("content_type"),
                F.format_string("2023-%02d-%02d", F.pmod("p_size", F.lit(13)), F.pmod("p_size", F.lit(28)) + 1).alias(
                    "upload_date"
                ),
                F.concat(F.lit("ED"), F.col("p_size").cast("string")).alias("editor_code"),
            )
        )

    def raw_rates(self) -> DataFrame:
        """Two periods per nation; nations of region 3 have no rate."""
        nation = self.table("nation").filter(F.col("n_regionkey") != 3)
        return nation.select("*", F.explode(F.array(F.lit(2024), F.lit(2025))).alias("year")).select(
            F.lower("n_name").alias("country"),
            F.concat(F.lit(" "), "n_name").alias("country_name"),
            (F.lit("0.0005").cast("decimal(8,4)") * (F.col("n_regionkey") + F.col("year") - 2023)).alias(
                "rate_per_view_usd"
            ),
            F.concat(F.col("year").cast("string"), F.lit("-01-01")).alias("effective_from"),
            F.concat(F.col("year").cast("string"), F.lit("-12-31")).alias("effective_to"),
        )

    def raw_rate_periods(self) -> DataFrame:
        """Three periods per nation: with gaps, overlapping for region 1, the last without an end."""
        nation = self.table("nation").filter(F.col("n_regionkey") != 3)
        years = nation.select("*", F.explode(F.array(F.lit(1996), F.lit(1998), F.lit(2000))).alias("year"))
        until = F.when(F.col("n_regionkey") == 1, F.format_string("%d-12-31", F.col("year") + 2)).otherwise(
            F.format_string("%d-06-30", F.col("year") + 1)
        )
        return years.select(
            F.lower("n_name").alias("country"),
            F.col("n_name").alias("country_name"),
            (F.lit("0.0005").cast("decimal(8,4)") * (F.col("n_regionkey") + F.col("year") - 1995)).alias(
                "rate_per_view_usd"
            ),
            F.format_string("%d-01-01", F.col("year")).alias("effective_from"),
            F.when(F.col("year") < 2000, until).alias("effective_to"),
        )

    def raw_views(self) -> DataFrame:
        """Quantity less 3: corrections make some counts negative; line 7 has no count."""
        suppliers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.lower("n_name").alias("country")
        )
        return (
            self.table("lineitem")
            .join(suppliers, "l_suppkey")
            .join(nations, "s_nationkey")
            .select(
                F.col("l_shipdate").cast("date").cast("string").alias("view_date"),
                F.concat(F.lit("VID"), F.col("l_partkey").cast("string")).alias("video_id"),
                "country",
                F.when(F.col("l_linenumber") != 7, F.col("l_quantity") - 3).alias("views"),
            )
        )

    def raw_partner_revenue(self) -> DataFrame:
        """Price less 2000 makes refunds; an eighth of the tax classes has no exchange rate."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.date_format("o_orderdate", "yyyyMM").alias("report_month"),
            F.col("o_orderstatus").alias("artist_id"),
            F.lower("o_orderpriority").alias("country"),
        )
        return (
            self.table("lineitem")
            .join(orders, "l_orderkey")
            .select(
                "report_month",
                F.col("l_suppkey").alias("distributor_id"),
                F.col("l_returnflag").alias("platform_id"),
                "artist_id",
                F.when(F.col("l_linenumber") != 7, F.col("l_partkey")).alias("track_id"),
                "country",
                F.col("l_quantity").alias("streams"),
                (F.col("l_extendedprice").cast("decimal(12,2)") - 2000).alias("revenue_original"),
                F.lit("usd").alias("currency"),
                F.when(
                    F.round(F.col("l_tax") * 100).cast("int") != 8,
                    1 - F.col("l_discount").cast("decimal(4,2)"),
                ).alias("exchange_rate"),
            )
        )

    def raw_mapping(self) -> DataFrame:
        """A row per order line: a part and a supplier meet many times."""
        return self.table("lineitem").select(
            F.concat(F.lit("T"), F.col("l_partkey").cast("string")).alias("asset_id"),
            F.col("l_suppkey").alias("contributor_id"),
            F.concat(F.lit(" "), "l_returnflag").alias("role_in_asset"),
            F.lit("equal").alias("allocation_method"),
            F.col("l_tax").alias("allocation_percent"),
        )

    def listens(self) -> DataFrame:
        return self.table("events").select(
            "user_id",
            F.get_json_object("props", "$.k").alias("recording_mbid"),
            F.col("ts").alias("listened_at"),
            "event_id",
        )

    def repeated_listens(self) -> DataFrame:
        """Listens plus, for a third of the recordings, a copy 20 seconds later."""
        listens = self.listens()
        copies = listens.filter(F.col("recording_mbid").cast("int") < 33).withColumn(
            "listened_at", F.col("listened_at") + F.expr("interval 20 seconds")
        )
        return listens.unionByName(copies)

    def words(self) -> DataFrame:
        """Documents as rows with a word list, in reading order."""
        return self.table("documents").select(
            F.lit(0).alias("file_no"),
            F.lit(0).alias("part_no"),
            F.col("doc_id").alias("row_no"),
            F.concat_ws("/", "lang", "source").alias("recording_mbid"),
            F.lit("doc ").alias("recording_name"),
            F.col("lang").alias("artist_name"),
            F.col("n_chars").cast("string").alias("release_name"),
            F.col("doc_id").cast("string").alias("release_mbid"),
            F.split("text", " ").alias("artist_credit_mbids"),
        )

    # conformed ---------------------------------------------------------------------------

    @cache
    def distributors(self) -> DataFrame:
        return conform(self.raw_distributors(), silver.DISTRIBUTORS)

    @cache
    def tracks(self) -> DataFrame:
        return conform(self.raw_tracks(), silver.TRACKS)

    @cache
    def videos(self) -> DataFrame:
        return conform(self.raw_videos(), silver.VIDEOS)

    @cache
    def rates(self) -> DataFrame:
        return conform(self.raw_rates(), silver.RATES)

    @cache
    def views(self) -> DataFrame:
        return conform(self.raw_views(), silver.VIEWS)

    @cache
    def partner_revenue(self) -> DataFrame:
        return conform(self.raw_partner_revenue(), silver.PARTNER_REVENUE)

    @cache
    def mapping(self) -> DataFrame:
        return conform(self.raw_mapping(), silver.MAPPING)

    # facts -------------------------------------------------------------------------------

    @cache
    def view_revenue(self) -> DataFrame:
        return facts.view_revenue_daily(self.views(), self.rates(), self.videos())

    @cache
    def partner_fact(self) -> DataFrame:
        return facts.partner_revenue_monthly(self.partner_revenue(), self.tracks())

    @cache
    def unified(self) -> DataFrame:
        return facts.revenue_unified(self.view_revenue(), self.partner_fact())

    @cache
    def shares(self) -> DataFrame:
        """1-4 suppliers per track and 2-5 per video; needs the assets' ids only."""
        tracks, videos = (raw.select("asset_id") for raw in (self.raw_tracks(), self.raw_videos()))
        return synth.whole_mapping(tracks, videos, self.people())

    @cache
    def people(self) -> DataFrame:
        """Contributors, one per supplier."""
        return synth.contributors(self.table("supplier").select((F.col("s_suppkey") + 1).alias("rank")))

    @cache
    def allocation(self) -> DataFrame:
        return facts.contributor_revenue(facts.asset_revenue(self.unified()), staged(self.shares(), "shares"))

    # generated masters -------------------------------------------------------------------

    @cache
    def synth_artists(self) -> DataFrame:
        """Every customer is an artist."""
        pool = self.table("customer").select(
            F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("artist_id"),
            F.col("c_name").alias("artist_name"),
        )
        return synth.artists(pool, None)

    @cache
    def synth_tracks(self) -> DataFrame:
        """Every part is a recording."""
        pool = self.table("part").select(
            F.concat(F.lit("R"), F.col("p_partkey").cast("string")).alias("recording_mbid"),
            F.col("p_name").alias("recording_name"),
            F.col("p_brand").alias("release_name"),
            F.col("p_type").alias("release_mbid"),
        )
        return synth.tracks(pool, self.synth_artists(), None)

    def spine(self, name: str, key: str) -> DataFrame:
        return self.table(name).select((F.col(key) + 1).cast("bigint").alias("rank"))

    @cache
    def synth_videos(self) -> DataFrame:
        """One video per supplier."""
        return synth.videos(self.spine("supplier", "s_suppkey"), self.synth_tracks())


