"""Streams, dimensions, facts and reports on small hand-made rows."""

from datetime import date
from decimal import Decimal

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from tallybeat.plans import dims, facts, kpis, streams
from tallybeat.operators.quality import count_tables_tolerant


@pytest.fixture
def tracks(spark):
    return spark.createDataFrame(
        [("r1", "AT1", "art", "D", "ACTIVE"), ("r2", "AT2", "art", "D", "INACTIVE"), ("r3", None, "art", "D", "ACTIVE")],
        "track_id string, asset_id string, artist_id string, distributor_id string, active_status string",
    )


def listens(spark, *rows):
    frame = spark.createDataFrame(rows, "user_id bigint, recording_mbid string, t string")
    return frame.select("user_id", "recording_mbid", F.col("t").cast("timestamp").alias("listened_at"))


def counts(spark, tracks, *rows):
    found = streams.stream_monthly(listens(spark, *rows), tracks)
    return rows_of(found, "listen_month", "recording_mbid", "stream_count", "unique_listeners")


def test_same_minute_is_one_stream(spark, tracks):
    rows = [(1, "r1", "2025-01-01 10:00:01"), (1, "r1", "2025-01-01 10:00:59")]
    assert counts(spark, tracks, *rows) == [("202501", "r1", 1, 1)]


def test_minute_boundary_is_two_streams(spark, tracks):
    rows = [(1, "r1", "2025-01-01 10:00:59"), (1, "r1", "2025-01-01 10:01:00")]
    assert counts(spark, tracks, *rows) == [("202501", "r1", 2, 1)]


def test_two_users_in_one_minute(spark, tracks):
    rows = [(1, "r1", "2025-01-01 10:00:01"), (2, "r1", "2025-01-01 10:00:02")]
    assert counts(spark, tracks, *rows) == [("202501", "r1", 2, 2)]


def test_unknown_user_counts_as_stream_not_as_listener(spark, tracks):
    rows = [(None, "r1", "2025-01-01 10:00:01"), (2, "r1", "2025-01-01 10:00:02")]
    assert counts(spark, tracks, *rows) == [("202501", "r1", 2, 1)]


def test_month_boundary(spark, tracks):
    rows = [(1, "r1", "2025-01-31 23:59:00"), (1, "r1", "2025-02-01 00:00:00")]
    assert counts(spark, tracks, *rows) == [("202501", "r1", 1, 1), ("202502", "r1", 1, 1)]


def test_inactive_unknown_and_missing_recordings(spark, tracks):
    rows = [(1, r, "2025-01-01 10:00:00") for r in ("r2", "zz", None)]
    assert counts(spark, tracks, *rows) == []
    assert rows_of(streams.active_members(listens(spark, *rows, (1, "r1", "2025-01-01 10:00:00")), tracks)) == [(2, 1)]


def test_hot_recording_against_brute_force(spark, tracks):
    rows = [(i % 40, "r1" if i % 3 else "r3", f"2025-01-{1 + i % 28:02d} 10:{i % 60:02d}:{i % 50:02d}") for i in range(3000)]
    for parts in (1, 6):
        found = streams.stream_monthly(listens(spark, *rows).repartition(parts), tracks)
        expected = []
        for recording in ("r1", "r3"):
            minutes = {(u, t[:16]) for u, r, t in rows if r == recording}
            expected.append(("202501", recording, len(minutes), len({u for u, _ in minutes})))
        assert rows_of(found, "listen_month", "recording_mbid", "stream_count", "unique_listeners") == expected


def test_streams_shuffle_only_narrow_columns(spark, tracks, tmp_path):
    listens(spark, (1, "r1", "2025-01-01 10:00:01")).withColumn("release_name", F.lit("x")).write.parquet(str(tmp_path / "l"))
    plan = plan_of(streams.stream_monthly(spark.read.parquet(str(tmp_path / "l")), tracks))
    assert "ReadSchema: struct<user_id:bigint,recording_mbid:string,listened_at:timestamp>" in plan
    assert "PushedFilters: [IsNotNull(recording_mbid)" in plan
    assert "LeftSemi" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_calendar(spark):
    days = dims.dim_date(dims.calendar_bounds(spark))
    assert days.count() == 1096
    assert rows_of(days.filter("date_key in (20241229, 20241230)")) == [
        (20241229, date(2024, 12, 29), 29, 52, 12, 4, 2024, "December", True),
        (20241230, date(2024, 12, 30), 30, 1, 12, 4, 2024, "December", False),
    ]


@pytest.fixture
def star(spark, tracks):
    views = spark.createDataFrame(
        [(date(2025, 1, 1), "v1", "VN", 100), (date(2025, 1, 1), "v1", "XX", 5), (date(2025, 1, 2), "zz", "VN", 1),
         (date(2025, 1, 2), "v2", "VN", 9)],
        "view_date date, video_id string, country string, views bigint",
    )
    rates = spark.createDataFrame([("VN", Decimal("0.50"))], "country string, rate_per_view_usd decimal(12,8)")
    videos = spark.createDataFrame(
        [("v1", "AV1", "ch", "t", date(2024, 1, 1), "p"), ("v2", None, "ch", "t", None, "p")],
        "video_id string, asset_id string, channel_id string, video_title string, upload_date date, project_name string",
    )
    revenue = spark.createDataFrame(
        [("202501", "D", "P", "art", "r1", "VN", 10, Decimal(100), "USD", Decimal(1), Decimal("100")),
         ("202501", "D", "P", "art", "r2", "VN", 10, Decimal(7), "USD", None, None),
         ("202501", "D", "P", "art", "zz", "VN", 10, Decimal(7), "USD", Decimal(1), Decimal(7))],
        "report_month string, distributor_id string, platform_id string, artist_id string, track_id string, country string, "
        "streams bigint, revenue_original decimal(18,6), currency string, exchange_rate decimal(18,10), revenue_usd decimal(18,8)",
    )
    by_view = facts.view_revenue_daily(views, rates, videos)
    by_partner = facts.partner_revenue_monthly(revenue, tracks)
    return by_view, by_partner, facts.revenue_unified(by_view, by_partner)


def test_view_fact_keeps_missing_rates_and_drops_orphans(star):
    found = rows_of(star[0], "date_key", "country", "views", "youtube_revenue_usd")
    assert found == [(20250101, "VN", 100, Decimal(50)), (20250101, "XX", 5, None)]


def test_partner_fact_keeps_inactive_tracks_and_drops_orphans(star):
    assert rows_of(star[1], "asset_id", "revenue_usd") == [("AT1", Decimal(100)), ("AT2", None)]


def test_unified(star):
    found = rows_of(star[2], "revenue_period", "period_type", "source_type", "asset_id", "asset_type", "platform_id", "views", "streams")
    assert found == sorted(
        [
            ("20250101", "DAILY", "YOUTUBE", "AV1", "VIDEO", "PLT_YTB", 100, None),
            ("20250101", "DAILY", "YOUTUBE", "AV1", "VIDEO", "PLT_YTB", 5, None),
            ("202501", "MONTHLY", "DISTRIBUTOR", "AT1", "TRACK", "P", None, 10),
            ("202501", "MONTHLY", "DISTRIBUTOR", "AT2", "TRACK", "P", None, 10),
        ],
        key=repr,
    )


def test_allocation(spark, star):
    mapping = spark.createDataFrame(
        [("AT1", c, "r", Decimal("0.3333")) for c in ("a", "b", "c")] + [("AT2", "a", "r", Decimal(1)), ("none", "a", "r", Decimal(1))],
        "asset_id string, contributor_id string, role_in_asset string, allocation_percent decimal(9,6)",
    )
    found = facts.contributor_revenue(facts.asset_revenue(star[2]), mapping)
    amounts = {(row.asset_id, row.contributor_id): row.allocated_revenue_usd for row in found.collect()}
    third = Decimal("33.33")
    assert amounts == {("AT1", "a"): third, ("AT1", "b"): third, ("AT1", "c"): third, ("AT2", "a"): None}
    top = [(row.contributor_id, row.total_allocated) for row in kpis.top_contributors(found).collect()]
    assert top == [("a", Decimal("33.33")), ("b", Decimal("33.33")), ("c", Decimal("33.33"))]
    same = kpis.top_contributors_from_assets(star[2], mapping).collect()
    assert [(row.contributor_id, row.total_allocated) for row in same] == top


def test_reports(star):
    by_view, by_partner, unified = star
    assert rows_of(kpis.total_revenue(unified)) == [(Decimal(150),)]
    assert [tuple(row) for row in kpis.revenue_by_source(unified).collect()] == [
        ("DISTRIBUTOR", Decimal(100)), ("YOUTUBE", Decimal(50)),
    ]
    assert rows_of(kpis.partner_revenue_by_month(by_partner)) == [("202501", 20, Decimal(100))]


def test_asset_dimension(spark, star):
    videos = spark.createDataFrame([("v1", "AV1", "ch", "title", date(2024, 1, 1), "p")],
        "video_id string, asset_id string, channel_id string, video_title string, upload_date date, project_name string")
    tracks = spark.createDataFrame([("r1", "AT1", "song", "m", "rel", "art", "D", "p", "l", None, "INACTIVE")],
        "track_id string, asset_id string, track_title string, recording_mbid string, release_mbid string, artist_id string, "
        "distributor_id string, project_name string, label_name string, release_date date, active_status string")
    assets = dims.dim_content_asset(videos, tracks)
    assert assets.columns == dims.ASSET_COLUMNS
    assert rows_of(assets, "asset_id", "asset_type", "asset_title", "video_id", "track_id", "active_status") == [
        ("AT1", "TRACK", "song", None, "r1", "INACTIVE"), ("AV1", "VIDEO", "title", "v1", None, "ACTIVE"),
    ]


def test_large_dimensions_fall_back_to_split_merge_joins(spark):
    """A counted rate table is broadcast; a large catalog is not, and a video with most views is cut into tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        views = spark.range(0, 40000, 1, 8).select(
            F.lit(date(2025, 1, 1)).alias("view_date"),
            F.when(F.col("id") % 3 > 0, "v0").otherwise(F.concat(F.lit("v"), (F.col("id") % 50).cast("string"))).alias("video_id"),
            F.when(F.col("id") % 3 > 0, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") % 97).cast("string"))).alias("country"),
            F.col("id").alias("views"),
        )
        rates = spark.createDataFrame(
            [(c, Decimal(1)) for c in ("HOT", *(f"C{i}" for i in range(97)))], "country string, rate_per_view_usd decimal(12,8)"
        )
        videos = spark.createDataFrame(
            [(f"v{i}", f"a{i}", "c") for i in range(50)], "video_id string, asset_id string, channel_id string"
        )
        fact = facts.view_revenue_daily(views, rates, videos)
        assert sum(row.youtube_revenue_usd for row in fact.collect()) == sum(range(40000))
        plan = plan_of(fact)  # the final one, after the run
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert plan.count("BroadcastHashJoin LeftOuter") > 0 and "hashpartitioning(country" not in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_tolerant_counts(spark, namespace, tmp_path):
    spark.range(3).write.saveAsTable(f"{namespace}.t")
    broken = tmp_path / "broken"
    spark.range(5).write.parquet(str(broken))
    spark.catalog.createTable(f"{namespace}.broken", path=str(broken), source="parquet")
    for file in broken.glob("part-*"):
        file.write_bytes(b"no parquet")
    names = [f"{namespace}.{name}" for name in ("t", "gone", "broken")]
    assert [(row.row_count, row.status) for row in count_tables_tolerant(spark, names).collect()] == [
        (3, "OK"), (None, "ERROR"), (None, "ERROR"), (3, "OK"),
    ]


def test_hot_recording_is_dealt_by_user_before_it_is_counted(spark):
    """Without a broadcast the catalog is joined on recording and a part of its users."""
    from tallybeat.plans import streams

    listens = spark.range(20000).select(
        F.col("id").alias("user_id"), F.lit("hot").alias("recording_mbid"), F.lit("2025-01-01 10:00:00").cast("timestamp").alias("listened_at")
    )
    tracks = spark.createDataFrame(
        [("hot", "a", "b", "d", "ACTIVE")], "track_id string, asset_id string, artist_id string, distributor_id string, active_status string"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = streams.stream_monthly(listens, tracks)
        plan = plan_of(rows)
        found = [(r.stream_count, r.unique_listeners) for r in rows.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == [(20000, 20000)]
    assert "hashpartitioning(recording_mbid" in plan and "_salt" in plan and "hashpartitioning(user_id" in plan


def test_large_amount_is_converted(spark):
    from tallybeat.plans.silver import converted_amount

    amount = spark.sql("SELECT 999999999999.5BD AS a, 1.0BD AS r").select(
        F.col("a").cast("decimal(18,6)").alias("revenue_original"), F.col("r").cast("decimal(18,10)").alias("exchange_rate")
    )
    assert str(amount.select(converted_amount().alias("x")).first().x) == "999999999999.50000000"


def test_tolerant_counts_in_one_job(spark, namespace, tmp_path):
    """All tables that can be read cost one job; a file that cannot be read costs some more, and no other table."""
    import glob

    for i in range(6):
        spark.range(i).write.saveAsTable(f"{namespace}.t{i}")
    path = str(tmp_path / "broken")
    spark.range(50).repartition(1).write.parquet(path)
    spark.catalog.createTable(f"{namespace}.broken", path=path, source="parquet")
    names = [f"{namespace}.t{i}" for i in range(6)]

    def jobs(make):
        spark.sparkContext.setJobGroup("tolerant", "")
        try:
            return make(), len(spark.sparkContext.statusTracker().getJobIdsForGroup("tolerant"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    whole, used = jobs(lambda: count_tables_tolerant(spark, names).collect())
    assert [(r.row_count, r.status) for r in whole] == [*((i, "OK") for i in range(6)), (15, "OK")]
    assert used <= 3  # one query, whose two stages adaptive execution submits one by one
    for name in glob.glob(f"{path}/part-*.parquet"):
        with open(name, "wb") as file:
            file.write(b"no longer a Parquet file")
    mixed = count_tables_tolerant(spark, [*names, f"{namespace}.broken", f"{namespace}.missing"]).collect()
    assert [(r.row_count, r.status) for r in mixed] == [
        *((i, "OK") for i in range(6)), (None, "ERROR"), (None, "ERROR"), (15, "OK"),
    ]


def test_absurd_views_do_not_stop_the_fact(spark):
    """9e18 views at a rate of 12: listed with a reason; the other rows are there."""
    day = F.to_date(F.lit("2025-01-01")).alias("view_date")
    views = spark.createDataFrame([("v", "US", 9 * 10**18), ("v", "US", 3), ("v", "XX", 9 * 10**18), ("v", "US", None)], "video_id string, country string, views bigint")
    views = views.select(day, "*")
    rates = spark.createDataFrame([("US", Decimal("12.0"))], "country string, rate_per_view_usd decimal(12,8)")
    videos = spark.createDataFrame([("v", "a", "c")], "video_id string, asset_id string, channel_id string")
    kept = facts.view_revenue_daily(views, rates, videos)
    assert rows_of(kept, "country", "views", "youtube_revenue_usd") == [
        ("US", 3, Decimal("36.00000000")), ("US", None, None), ("XX", 9 * 10**18, None),
    ]
    refused = facts.view_revenue_rejects(views, rates, videos)
    assert rows_of(refused, "country", "views", "reject_reason") == [("US", 9 * 10**18, facts.TOO_LARGE)]
    plan = plan_of(kept)
    assert "BroadcastHashJoin" in plan


def test_large_catalog_is_not_broadcast(spark, tmp_path):
    """60,000 tracks in small files are merged and only then repeated; a few are broadcast once."""
    made = spark.range(60_000).select(
        F.col("id").cast("string").alias("track_id"), *[F.lit("a").alias(c) for c in ("asset_id", "artist_id", "distributor_id")],
        F.lit("ACTIVE").alias("active_status"),
    )
    made.write.parquet(str(tmp_path / "tracks"))
    tracks = spark.read.parquet(str(tmp_path / "tracks"))
    heard = listens(spark, (1, "7", "2025-01-01 10:00:01"), (2, "7", "2025-01-01 10:00:02"), (1, "gone", "2025-01-01 10:00:01"))
    large = streams.stream_monthly(heard, tracks)
    assert "BroadcastExchange" not in plan_of(large) and "_salt" in plan_of(large)
    few = streams.stream_monthly(heard, tracks.filter("track_id < 50"))
    assert "BroadcastExchange" in plan_of(few) and "_salt" not in plan_of(few)
    for found in (large, few):
        assert rows_of(found, "listen_month", "recording_mbid", "stream_count", "unique_listeners") == [("202501", "7", 2, 2)]
    assert rows_of(streams.active_members(heard, tracks)) == [(60_000, 1)]
