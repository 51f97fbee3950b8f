"""The whole lakehouse: bronze files to silver tables to gold tables to reports.

Steps hand over by table name, so each one starts from files, can be repeated alone and
carries no lineage of the steps before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat import constants as k
from tallybeat.operators.conform import TableSpec, conform
from tallybeat.operators.quality import count_tables_tolerant, prefix_usage
from tallybeat.plans import dims, facts, kpis, silver, streams, synth
from tallybeat.sources import files, tables

LISTENS = "listenbrainz"
SILVER_TABLES = [*(s.name for s in silver.MASTERS), *(s.name for s in silver.TRANSACTIONS), silver.STREAMS]
GOLD_TABLES = [
    "dim_date",
    *dims.COPIES,
    "dim_content_asset",
    "fact_youtube_revenue_daily",
    "fact_distributor_revenue_monthly",
    "fact_content_revenue_unified",
    "fact_contributor_revenue",
]


class Lakehouse:
    """Names of the two namespaces and of the log, and the writes into them."""

    def __init__(
        self,
        spark: SparkSession,
        silver_namespace: str = k.SILVER,
        gold_namespace: str = k.GOLD,
        log: str | None = None,
        location: str | None = None,
    ):
        self.spark = spark
        self.silver = silver_namespace
        self.gold = gold_namespace
        self.log = log
        for namespace in (self.silver, self.gold):
            place = f"{location}/{namespace}" if location else None
            tables.create_namespace(spark, namespace, place)

    def read(self, namespace: str, name: str) -> DataFrame:
        return self.spark.table(f"{namespace}.{name}")

    def write(self, rows: DataFrame, namespace: str, name: str, partition_by: str | None = None) -> int:
        full = f"{namespace}.{name}"
        count = tables.write_table(rows, full, partition_by)
        if self.log:
            tables.log_write(self.spark, self.log, full, count, "create or replace")
        return count

    # silver ------------------------------------------------------------------------------

    def conform_table(self, bronze: str, spec: TableSpec) -> int:
        """One bronze CSV folder to its conformed table."""
        with tables.staging(self.spark):
            raw = files.read_csv(self.spark, f"{bronze}/{spec.name}", free_text=spec.free_text)
            return self.write(conform(raw, spec), self.silver, spec.name, spec.partition_by)

    def build_streams(self, bronze: str, ingested_date: str) -> int:
        """Listens of one ingest date to monthly streams of the active tracks."""
        listens = files.read_listens(self.spark, f"{bronze}/{LISTENS}", ingested_date)
        with tables.staging(self.spark):
            monthly = streams.stream_monthly(listens, self.read(self.silver, "tracks"))
            return self.write(monthly, self.silver, silver.STREAMS, "listen_month")

    def build_silver(self, bronze: str, ingested_date: str) -> dict[str, int]:
        counts = {
            spec.name: self.conform_table(bronze, spec)
            for spec in (*silver.MASTERS, *silver.TRANSACTIONS)
        }
        counts[silver.STREAMS] = self.build_streams(bronze, ingested_date)
        return counts

    # gold --------------------------------------------------------------------------------

    def build_gold(self) -> dict[str, int]:
        def of_silver(name: str) -> DataFrame:
            return self.read(self.silver, name)

        def of_gold(name: str) -> DataFrame:
            return self.read(self.gold, name)

        counts: dict[str, int] = {}

        def add(name: str, rows: DataFrame, partition_by: str | None = None) -> None:
            counts[name] = self.write(rows, self.gold, name, partition_by)

        add("dim_date", dims.dim_date(dims.calendar_bounds(self.spark)))
        for name, source in dims.COPIES.items():
            add(name, of_silver(source))
        videos, tracks = of_silver("youtube_videos"), of_silver("tracks")
        add("dim_content_asset", dims.dim_content_asset(videos, tracks))
        add(
            "fact_youtube_revenue_daily",
            facts.view_revenue_daily(of_silver("youtube_view_daily"), of_silver("youtube_rate"), videos),
            "date_key",
        )
        add(
            "fact_distributor_revenue_monthly",
            facts.partner_revenue_monthly(of_silver("distributor_revenue_monthly"), tracks),
            "month_key",
        )
        add(
            "fact_content_revenue_unified",
            facts.revenue_unified(
                of_gold("fact_youtube_revenue_daily"), of_gold("fact_distributor_revenue_monthly")
            ),
            "source_type",
        )
        with tables.staging(self.spark):
            assets = facts.asset_revenue(of_gold("fact_content_revenue_unified"))
            mapping = of_silver("content_contributor_mapping")
            add("fact_contributor_revenue", facts.contributor_revenue(assets, mapping), "source_type")
        return counts

    # reports -----------------------------------------------------------------------------

    def report(self) -> dict[str, DataFrame]:
        unified = self.read(self.gold, "fact_content_revenue_unified")
        partner = self.read(self.gold, "fact_distributor_revenue_monthly")
        revenue = self.read(self.silver, "distributor_revenue_monthly")
        names = [f"{self.silver}.{t}" for t in SILVER_TABLES] + [f"{self.gold}.{t}" for t in GOLD_TABLES]
        return {
            "row counts": count_tables_tolerant(self.spark, names),
            "total revenue": kpis.total_revenue(unified),
            "revenue by source": kpis.revenue_by_source(unified),
            "top contributors": kpis.top_contributors(self.read(self.gold, "fact_contributor_revenue")),
            "partner revenue by month": kpis.partner_revenue_by_month(partner),
            "reported revenue by month": kpis.partner_revenue_by_month(revenue, "report_month"),
            "top streams": kpis.top_streams(self.read(self.silver, silver.STREAMS)),
        }

    # clean-up ----------------------------------------------------------------------------

    def drop(self) -> list[str]:
        """Drop all tables of both namespaces."""
        return [
            name
            for namespace in (self.silver, self.gold)
            for name in tables.drop_tables(self.spark, namespace)
        ]


def generate_bronze(
    spark: SparkSession,
    listens_path: str,
    bronze: str,
    sample_files: int = 10,
    seed: str = synth.SEED,
    track_count: int = k.TRACK_COUNT,
    artist_count: int = k.ARTIST_COUNT,
    contributor_count: int = k.CONTRIBUTOR_COUNT,
    channel_count: int = k.CHANNEL_COUNT,
    video_count: int = k.VIDEO_COUNT,
    month_count: int = k.MONTH_COUNT,
    view_days: int = k.VIEW_DAYS,
) -> None:
    """Write the reference CSVs, made from ids found in the first landed listen files."""
    with tables.staging(spark):
        pool_columns = [
            "recording_mbid",
            "recording_name",
            "artist_name",
            "artist_credit_mbids",
            "release_name",
            "release_mbid",
        ]
        listens = files.first_files(spark, listens_path, sample_files, pool_columns)
        # Masters feed several outputs: make them once, in the shared folder.
        artists = tables.staged(synth.artists(synth.artist_pool(listens), artist_count, seed), "artists")
        tracks = tables.staged(
            synth.tracks(synth.recording_pool(listens), artists, track_count, seed), "tracks"
        )
        contributors = synth.contributors(synth.numbers(spark, contributor_count), seed)
        videos = tables.staged(
            synth.videos(synth.numbers(spark, video_count), tracks, channel_count, seed), "videos"
        )
        outputs = {
            "platforms": synth.platforms(spark),
            "distributors": synth.distributors(spark),
            "youtube_rate": synth.rates(spark),
            "artists": artists,
            "tracks": tracks,
            "contributors": contributors,
            "youtube_channels": synth.channels(synth.numbers(spark, channel_count), seed),
            "youtube_videos": videos,
            "distributor_revenue_monthly": synth.partner_revenue(tracks, month_count, seed),
            "youtube_view_daily": synth.daily_views(videos, view_days, seed),
            "content_contributor_mapping": synth.whole_mapping(tracks, videos, contributors, seed),
        }
        for name, rows in outputs.items():
            files.write_csv(rows.drop("rank") if "rank" in rows.columns else rows, f"{bronze}/{name}")


#: More rows than a report has.
EVERY = 2**31 - 2


def show(reports: dict[str, DataFrame]) -> None:
    for title, rows in reports.items():
        print(title)
        rows.show(EVERY, truncate=False)


def inventory(spark: SparkSession, bronze: str) -> DataFrame:
    """Files and bytes per bronze folder and in total."""
    return prefix_usage(files.list_files(spark, bronze)).orderBy(F.col("prefix") == "TOTAL", "prefix")
