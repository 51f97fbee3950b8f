"""Seeded bronze data: master tables, partner revenue, daily views, contributor mapping.

Every value is a function of the seed and of the row's own key (``functions.seeded``), so
rows are made where their parent row is: revenue and views expand each track or video in
place with arrays and need no shuffle, cross join or loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat import constants as k
from tallybeat.functions.columns import clamp, padded_id
from tallybeat.functions.seeded import (
    choice,
    day_between,
    distinct_choices,
    distinct_numbers,
    draw,
    pareto,
    seasonality,
    uniform,
    weighted_choice,
    whole,
)
from tallybeat.operators.dedupe import first_seen, flatten_lists
from tallybeat.operators.ranking import hash_rank

SEED = "42"
POSITION = ["file_no", "part_no", "row_no"]
COUNTRY_WEIGHTS = {code: weight for code, _, _, weight in k.COUNTRIES}


def _status(seed: str, active_percent: int, key: Column) -> Column:
    hit = F.pmod(draw(seed, key), F.lit(100)) < active_percent
    return F.when(hit, F.lit(k.ACTIVE)).otherwise(F.lit(k.INACTIVE))


def _spread(parents: DataFrame, key: str) -> DataFrame:
    """Parents over as many tasks as a shuffle has, however few bytes they are.

    Partitions are otherwise sized by the parents, and each parent is about to become
    hundreds of rows. A given number of partitions is left alone by adaptive execution.
    """
    width = int(parents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parents.repartition(width, key)


def _size(rows: DataFrame) -> Column:
    """Number of rows as a scalar subquery: one value, computed inside the job."""
    return rows.select(F.count("*")).scalar()


# Pools -----------------------------------------------------------------------------------


def recording_pool(listens: DataFrame) -> DataFrame:
    """First name, artist and release seen for every recording, in reading order."""
    named = ["recording_name", "artist_name", "release_name", "release_mbid"]
    return first_seen(listens, "recording_mbid", POSITION, named)


def artist_pool(listens: DataFrame) -> DataFrame:
    """First name seen for every artist of the credit lists.

    All credits of a row carry the row's name, so the order within a list is of no account.
    """
    credits = flatten_lists(
        listens, "artist_credit_mbids", "artist_id", [*POSITION, "artist_name"]
    )
    return first_seen(credits, "artist_id", POSITION, ["artist_name"])


def pool_sizes(recordings: DataFrame, artists: DataFrame) -> DataFrame:
    count = F.count("*").alias("ids")
    return (
        recordings.agg(count)
        .select(F.lit("recordings").alias("pool"), "ids")
        .unionByName(artists.agg(count).select(F.lit("artists").alias("pool"), "ids"))
    )


# Master data -----------------------------------------------------------------------------


def platforms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        k.PLATFORMS, "platform_id string, platform_name string, platform_type string"
    )


def distributors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        k.DISTRIBUTORS,
        "distributor_id string, distributor_name string, payment_cycle string, active_status string",
    )


def rates(spark: SparkSession) -> DataFrame:
    rows = [(code, name, rate) for code, name, rate, _ in k.COUNTRIES]
    return spark.createDataFrame(
        rows, "country string, country_name string, rate_per_view_usd string"
    ).select(
        "*",
        F.lit(k.CALENDAR_START).alias("effective_from"),
        F.lit(k.CALENDAR_END).alias("effective_to"),
    )


def artists(pool: DataFrame, count: int | None = k.ARTIST_COUNT, seed: str = SEED) -> DataFrame:
    """A sample of the artist pool (all of it without ``count``), numbered by ``rank``."""
    key = F.col("artist_id")
    houses = [house for house, *_ in k.DISTRIBUTORS]
    return hash_rank(pool, "artist_id", f"{seed}.artists", count).select(
        "rank",
        "artist_id",
        "artist_name",
        choice(f"{seed}.artist.distributor", houses, key).alias("distributor_id"),
        choice(f"{seed}.artist.label", k.LABELS, key).alias("label_name"),
        choice(f"{seed}.artist.project", k.PROJECTS, key).alias("project_name"),
        _status(f"{seed}.artist.status", 90, key).alias("active_status"),
        day_between(f"{seed}.artist.created", "2020-01-01", "2023-12-31", key).alias("created_date"),
    )


def tracks(
    pool: DataFrame,
    artists: DataFrame,
    count: int | None = k.TRACK_COUNT,
    seed: str = SEED,
    isrc_prefix: str = "VN-TLB",
) -> DataFrame:
    """A sample of the recording pool; distributors are those of the drawn artists."""
    key = F.col("recording_mbid")
    drawn = hash_rank(pool, "recording_mbid", f"{seed}.tracks", count).withColumn(
        "_artist", F.pmod(draw(f"{seed}.track.artist", key), _size(artists)) + 1
    )
    owners = artists.select(F.col("rank").alias("_artist"), "artist_id", "distributor_id")
    return drawn.join(owners, "_artist").select(
        "rank",
        key.alias("track_id"),
        F.col("recording_name").alias("track_title"),
        padded_id("AST_T", F.col("rank"), 4).alias("asset_id"),
        F.format_string(
            f"{isrc_prefix}-%d-%d",
            whole(f"{seed}.track.isrc.year", 10, 99, key),
            whole(f"{seed}.track.isrc.number", 10000, 99999, key),
        ).alias("isrc"),
        "recording_mbid",
        "release_mbid",
        "release_name",
        "artist_id",
        "distributor_id",
        choice(f"{seed}.track.label", k.LABELS, key).alias("label_name"),
        choice(f"{seed}.track.project", k.PROJECTS, key).alias("project_name"),
        day_between(f"{seed}.track.released", "2021-01-01", "2024-06-30", key).alias("release_date"),
        _status(f"{seed}.track.status", 85, key).alias("active_status"),
    )


def numbers(spark: SparkSession, count: int) -> DataFrame:
    """1..count as ``rank``."""
    return spark.range(1, count + 1).withColumnRenamed("id", "rank")


def contributors(spine: DataFrame, seed: str = SEED) -> DataFrame:
    """One contributor per ``rank`` of the spine."""
    key = F.col("rank")
    return spine.select(
        "rank",
        padded_id("CTB", key, 3).alias("contributor_id"),
        padded_id("Nghệ sĩ ", key, 3).alias("contributor_name"),
        choice(f"{seed}.contributor.team", k.TEAMS, key).alias("team"),
        choice(f"{seed}.contributor.role", k.ROLES, key).alias("default_role"),
        _status(f"{seed}.contributor.status", 90, key).alias("active_status"),
    )


def channels(spine: DataFrame, seed: str = SEED) -> DataFrame:
    """One channel per ``rank`` of the spine."""
    key = F.col("rank")
    return spine.select(
        "rank",
        padded_id("CHN", key, 3).alias("channel_id"),
        padded_id("Channel ", key, 3).alias("channel_name"),
        choice(f"{seed}.channel.team", k.TEAMS, key).alias("owner_team"),
        day_between(f"{seed}.channel.created", "2019-01-01", "2022-12-31", key).alias("created_date"),
        F.lit(k.ACTIVE).alias("active_status"),
    )


def videos(
    spine: DataFrame, tracks: DataFrame, channel_count: int = k.CHANNEL_COUNT, seed: str = SEED
) -> DataFrame:
    """One video per ``rank`` of the spine; they take the tracks in turn."""
    key = F.col("rank")
    turn = spine.withColumn("_track", F.pmod(key - 1, _size(tracks)) + 1)
    songs = tracks.select(F.col("rank").alias("_track"), "track_id", "track_title", "project_name")
    label = choice(f"{seed}.video.label", k.CONTENT_TYPES, key)
    return turn.join(songs, "_track").select(
        "rank",
        padded_id("VID", key, 4).alias("video_id"),
        F.concat("track_title", F.lit(" ("), label, F.lit(")")).alias("video_title"),
        padded_id("AST_V", key, 4).alias("asset_id"),
        padded_id("CHN", whole(f"{seed}.video.channel", 1, channel_count, key), 3).alias("channel_id"),
        "track_id",
        "project_name",
        choice(f"{seed}.video.type", k.CONTENT_TYPES, key).alias("content_type"),
        day_between(f"{seed}.video.uploaded", "2022-01-01", "2026-05-31", key).alias("upload_date"),
        F.format_string("ED%d", whole(f"{seed}.video.editor", 100, 999, key)).alias("editor_code"),
    )


# Transactions ----------------------------------------------------------------------------


def partner_revenue(tracks: DataFrame, months: int = k.MONTH_COUNT, seed: str = SEED) -> DataFrame:
    """Active tracks x 1-3 platforms x months x the distinct ones of 2-5 weighted countries."""
    track, platform, month, country = (
        F.col(c) for c in ("track_id", "platform_id", "report_month", "country")
    )
    on_platforms = distinct_choices(
        f"{seed}.revenue.platform",
        list(k.STREAM_RATES),
        whole(f"{seed}.revenue.platforms", 1, 3, track),
        track,
    )
    draws = F.transform(
        F.sequence(F.lit(1).cast("bigint"), whole(f"{seed}.revenue.countries", 2, 5, track, platform, month)),
        lambda i: weighted_choice(f"{seed}.revenue.country", COUNTRY_WEIGHTS, track, platform, month, i),
    )
    rate = F.coalesce(
        *[F.when(platform == p, F.lit(r).cast("decimal(6,4)")) for p, r in k.STREAM_RATES.items()]
    )
    base = whole(f"{seed}.revenue.base", 500, 50000, track, platform, month, country)
    first = F.to_date(F.lit(k.FIRST_MONTH))
    active = tracks.filter(F.col("active_status") == k.ACTIVE)
    expanded = (
        _spread(active.select("distributor_id", "artist_id", "track_id"), "track_id")
        .select("*", F.explode(on_platforms).alias("platform_id"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("_month"))
        .select("*", F.add_months(first, F.col("_month")).alias("_day"))
        .withColumn("report_month", F.date_format("_day", "yyyyMM"))
        .select("*", F.explode(F.array_distinct(draws)).alias("country"))
    )
    return expanded.withColumn(
        "streams", F.floor(base * seasonality(F.month("_day"))).cast("bigint")
    ).select(
        "report_month",
        "distributor_id",
        "platform_id",
        "artist_id",
        "track_id",
        "country",
        "streams",
        F.round(F.col("streams") * rate, 4).cast("decimal(18,4)").alias("revenue_original"),
        F.lit("USD").alias("currency"),
        F.lit("1.0").cast("decimal(4,1)").alias("exchange_rate"),
    )


def daily_views(videos: DataFrame, days: int = k.VIEW_DAYS, seed: str = SEED) -> DataFrame:
    """Views of 3-8 countries per video, on two of five days since the upload."""
    video, country, day = (F.col(c) for c in ("video_id", "country", "view_date"))
    watched_in = distinct_choices(
        f"{seed}.views.country", list(COUNTRY_WEIGHTS), whole(f"{seed}.views.countries", 3, 8, video), video
    )
    first = F.to_date(F.lit(k.FIRST_MONTH))
    start = F.greatest(F.datediff("upload_date", first), F.lit(0))
    offsets = F.when(start < days, F.sequence(start, F.lit(days - 1)))
    expanded = (
        _spread(videos.select("video_id", "upload_date"), "video_id")
        .select("*", F.explode(watched_in).alias("country"))
        .select("video_id", "country", F.explode(offsets).alias("_day"))
        .select("video_id", "country", F.date_add(first, F.col("_day")).alias("view_date"))
        .filter(uniform(f"{seed}.views.day", video, country, day) < 0.4)
    )
    amount = F.floor(pareto(f"{seed}.views.amount", 1.5, video, country, day) * 1000) + 10
    return expanded.select(
        "view_date", "video_id", "country", clamp(amount, 0, 500000).cast("bigint").alias("views")
    )


def contributor_mapping(
    assets: DataFrame, contributors: DataFrame, fewest: int, most: int, seed: str = SEED
) -> DataFrame:
    """``fewest`` to ``most`` different contributors per asset, with equal rounded shares."""
    asset = F.col("asset_id")
    wanted = whole(f"{seed}.mapping.size", fewest, most, asset)
    team = distinct_numbers(f"{seed}.mapping.member", wanted, F.col("_total"), asset)
    counted = _spread(assets.select("asset_id"), "asset_id").select("asset_id", _size(contributors).alias("_total"))
    # An outer explode infers no filter on the team, which would draw it a second time.
    # The share is one per asset, so it is divided before the team becomes rows; none for an empty team.
    share = F.round(F.lit(1).cast("decimal(10,8)") / F.nullif(F.size("_team"), F.lit(0)), 4).cast("decimal(6,4)")
    chosen = (
        counted.select("asset_id", team.alias("_team"))
        .select("asset_id", "_team", share.alias("allocation_percent"))
        .select("asset_id", "allocation_percent", F.explode_outer("_team").alias("rank"))
    )
    people = contributors.select(
        "rank", "contributor_id", F.col("default_role").alias("role_in_asset")
    )
    return chosen.join(people, "rank").select(
        "asset_id",
        "contributor_id",
        "role_in_asset",
        F.lit(k.EQUAL).alias("allocation_method"),
        "allocation_percent",
    )


def whole_mapping(
    tracks: DataFrame, videos: DataFrame, contributors: DataFrame, seed: str = SEED
) -> DataFrame:
    """1-4 contributors per track and 2-5 per video."""
    return contributor_mapping(tracks, contributors, 1, 4, seed).unionByName(
        contributor_mapping(videos, contributors, 2, 5, seed)
    )
