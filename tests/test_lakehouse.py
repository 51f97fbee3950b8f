"""Raw files to reports, end to end."""

from conftest import rows_of
from pyspark.sql import functions as F

from tallybeat import jobs
from tallybeat.plans import ingest, lakehouse
from tallybeat.session import run_dir
from tallybeat.sources import files, tables

DATE = "2025-02-01"


def raw_listens(spark):
    n = F.col("id")
    return spark.range(4000).select(
        F.timestamp_seconds(1735689600 + n * 700).alias("listened_at"),
        F.current_timestamp().alias("created"),
        (n % 37).alias("user_id"),
        F.lit("ms").alias("recording_msid"),
        F.concat(F.lit("artist "), n % 20).alias("artist_name"),
        (n % 20).alias("artist_credit_id"),
        F.lit('the "best", of').alias("release_name"),
        F.lit("rel").alias("release_mbid"),
        F.concat(F.lit("song\n"), n % 90).alias("recording_name"),
        F.when(n % 13 != 0, F.concat(F.lit("rec"), F.when(n % 3 == 0, F.lit(1)).otherwise(n % 90))).alias("recording_mbid"),
        F.when(n % 7 != 0, F.array(F.concat(F.lit("art"), n % 20), F.concat(F.lit("art"), n % 31))).alias("artist_credit_mbids"),
    )


def test_end_to_end(spark):
    base, staged = run_dir(spark, "house"), tables.staged_folders(spark)
    raw, bronze = f"{base}/raw", f"{base}/bronze"
    raw_listens(spark).repartition(3).write.parquet(raw)
    entries = ingest.ingest(spark, raw, f"{bronze}/{lakehouse.LISTENS}", DATE)
    assert rows_of(ingest.outcome(entries), "status", "landed_rows") == [("LOADED", 4000)]
    lakehouse.generate_bronze(
        spark,
        f"{bronze}/{lakehouse.LISTENS}",
        bronze,
        track_count=40,
        artist_count=12,
        contributor_count=9,
        channel_count=4,
        video_count=10,
        month_count=6,
        view_days=60,
    )
    tag = base.rsplit("-", 1)[1][:8]
    house = lakehouse.Lakehouse(spark, f"s_{tag}", f"g_{tag}", location=base)
    house.log = f"{house.silver}.run_log"
    made = {**house.build_silver(bronze, DATE), **house.build_gold()}
    assert tables.staged_folders(spark) == staged  # nothing of the run stays
    assert set(made) == {*lakehouse.SILVER_TABLES, *lakehouse.GOLD_TABLES}
    assert made["tracks"] == 40 and made["dim_content_asset"] == 50 and made["dim_date"] == 1096
    assert all(count > 0 for count in made.values())
    for name, count in made.items():
        namespace = house.gold if name in lakehouse.GOLD_TABLES else house.silver
        assert spark.table(f"{namespace}.{name}").count() == count

    def total(frame, column):
        return frame.agg(F.sum(column)).collect()[0][0]

    gold = {name: spark.table(f"{house.gold}.{name}") for name in lakehouse.GOLD_TABLES}
    views, partner = gold["fact_youtube_revenue_daily"], gold["fact_distributor_revenue_monthly"]
    unified, split = gold["fact_content_revenue_unified"], gold["fact_contributor_revenue"]
    assert total(unified, "revenue_usd") == total(views, "youtube_revenue_usd") + total(partner, "revenue_usd")
    # Nothing is lost between raw CSV and fact: every generated row has its asset.
    assert made["fact_youtube_revenue_daily"] == made["youtube_view_daily"]
    assert made["fact_distributor_revenue_monthly"] == made["distributor_revenue_monthly"]
    raw_views = files.read_csv(spark, f"{bronze}/youtube_view_daily")
    assert total(raw_views.select(F.col("views").cast("bigint")), "views") == total(views, "views")
    # Contributors get the asset's revenue times the sum of its percentages.
    shares = spark.table(f"{house.silver}.content_contributor_mapping").groupBy("asset_id").agg(F.sum("allocation_percent").alias("p"))
    expected = unified.groupBy("asset_id").agg(F.sum("revenue_usd").alias("r")).join(shares, "asset_id")
    exact = expected.select((F.col("r").cast("decimal(26,8)") * F.col("p").cast("decimal(9,6)")).alias("amount"))
    assert total(split, "allocated_revenue_usd") == total(exact, "amount")
    days = gold["dim_date"].select("date_key")
    assert views.join(days, "date_key", "left_anti").count() == 0
    streams = spark.table(f"{house.silver}.listenbrainz_stream_monthly")
    assert total(streams, "stream_count") <= 4000 and streams.filter("unique_listeners > stream_count").count() == 0

    reports = house.report()
    assert reports["row counts"].filter("status = 'ERROR'").count() == 0
    assert reports["top contributors"].count() == 9
    assert tables.latest_writes(spark, house.log).count() == 10
    assert {row.prefix for row in lakehouse.inventory(spark, bronze).collect()} >= {"tracks", "listenbrainz", "TOTAL"}
    # A second build replaces every table with the same content.
    before = rows_of(split)
    house.log = None
    house.build_gold()
    assert rows_of(spark.table(f"{house.gold}.fact_contributor_revenue")) == before
    jobs.main(["report", "--silver", house.silver, "--gold", house.gold])
    assert len(house.drop()) == len(made) + 1  # and the log
