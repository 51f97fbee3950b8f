import hashlib
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tallybeat import constants as k
from tallybeat.functions.columns import date_key
from tallybeat.functions.seeded import distinct_numbers, whole
from tallybeat.plans import synth


@pytest.fixture(scope="module")
def masters(spark):
    recordings = spark.range(120).select(
        F.concat(F.lit("r"), "id").alias("recording_mbid"), F.concat(F.lit("song "), "id").alias("recording_name"),
        F.lit("rel").alias("release_name"), F.lit("rm").alias("release_mbid"),
    )
    people = spark.range(40).select(F.concat(F.lit("a"), "id").alias("artist_id"), F.lit("n").alias("artist_name"))
    artists = synth.artists(people, 15)
    tracks = synth.tracks(recordings, artists, 60)
    contributors = synth.contributors(synth.numbers(spark, 50))
    videos = synth.videos(synth.numbers(spark, 25), tracks)
    return artists, tracks, contributors, videos


def test_masters(masters):
    artists, tracks, contributors, videos = masters
    assert artists.count() == 15 and tracks.count() == 60 and videos.count() == 25
    assert tracks.select("asset_id").distinct().count() == 60
    assert [row.asset_id for row in tracks.orderBy("rank").limit(2).collect()] == ["AST_T0001", "AST_T0002"]
    owners = artists.select("artist_id", F.col("distributor_id").alias("expected"))
    assert tracks.join(owners, "artist_id").filter("distributor_id <> expected").count() == 0
    titles = videos.join(tracks.select("track_id", "track_title"), "track_id")
    assert titles.filter(F.col("video_title").startswith(F.col("track_title"))).count() == 25
    assert rows_of(contributors.agg(F.min("contributor_id"), F.max("contributor_id"))) == [("CTB001", "CTB050")]


def test_revenue(masters):
    tracks = masters[1]
    revenue = synth.partner_revenue(tracks)
    rows = revenue.collect()
    active = {row.track_id for row in tracks.filter("active_status = 'ACTIVE'").collect()}
    assert {row.track_id for row in rows} == active
    keys = [(row.report_month, row.platform_id, row.track_id, row.country) for row in rows]
    assert len(keys) == len(set(keys))
    platforms, countries = defaultdict(set), defaultdict(set)
    for month, platform, track, country in keys:
        platforms[track].add(platform)
        countries[month, platform, track].add(country)
    assert {len(p) for p in platforms.values()} == {1, 2, 3}
    assert max(len(c) for c in countries.values()) <= 5
    assert len({month for month, *_ in keys}) == 24 and min(keys)[0] == "202501"
    for row in rows:
        assert 350 <= row.streams <= 65000
        assert row.revenue_original == round(row.streams * Decimal(k.STREAM_RATES[row.platform_id]), 4)
    by_country = defaultdict(int)
    for key in keys:
        by_country[key[3]] += 1
    assert by_country["VN"] > by_country["US"] > by_country["NL"]


def test_views(masters):
    videos = masters[3]
    views = synth.daily_views(videos)
    late = views.join(videos.select("video_id", "upload_date"), "video_id").filter("view_date < upload_date")
    assert late.count() == 0
    low, high, first, last = views.agg(F.min("views"), F.max("views"), F.min("view_date"), F.max("view_date")).collect()[0]
    assert low >= 10 and high <= 500000 and str(first) >= "2025-01-01" and str(last) <= "2026-12-21"
    per_video = views.groupBy("video_id").agg(F.countDistinct("country").alias("n"))
    assert per_video.filter("n > 8").count() == 0
    assert views.count() == views.select("view_date", "video_id", "country").distinct().count()


@pytest.mark.parametrize("people", [3, 6, 50])
def test_mapping(spark, masters, people):
    _, tracks, _, videos = masters
    contributors = synth.contributors(synth.numbers(spark, people))
    teams = defaultdict(list)
    for row in synth.whole_mapping(tracks, videos, contributors).collect():
        teams[row.asset_id].append((row.contributor_id, row.allocation_percent))
    assert len(teams) == 85
    for asset, members in teams.items():
        assert len({c for c, _ in members}) == len(members)
        assert len(members) <= min(people, 4 if "_T" in asset else 5)
        assert {share for _, share in members} == {round(Decimal(1) / len(members), 4)}


def test_same_data_in_any_partitioning(spark, masters):
    _, tracks, contributors, videos = masters
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def everything(t, v):
        return [rows_of(f) for f in (synth.partner_revenue(t, 3), synth.daily_views(v, 30), synth.whole_mapping(t, v, contributors))]

    expected = everything(tracks, videos)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert everything(tracks.repartition(3, "isrc"), videos.repartition(5, "editor_code")) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pools(spark):
    listens = spark.createDataFrame(
        [(2, 0, 0, "r1", "late", "x", ["a1"]), (1, 0, 5, "r1", "early", "y", ["a2", "a1"]), (1, 0, 9, "", "none", "z", None)],
        "file_no int, part_no int, row_no int, recording_mbid string, recording_name string, artist_name string, artist_credit_mbids array<string>",
    ).withColumns({"release_name": F.lit("n"), "release_mbid": F.lit("m")})
    recordings, artists = synth.recording_pool(listens), synth.artist_pool(listens)
    assert rows_of(recordings, "recording_mbid", "recording_name") == [("r1", "early")]
    assert rows_of(artists) == [("a1", "y"), ("a2", "y")]
    assert rows_of(synth.pool_sizes(recordings, artists)) == [("artists", 2), ("recordings", 1)]


def test_distinct_numbers_reach_every_set(spark):
    """All sets of 2 of 5 about equally often, distant pairs of many, all numbers where fewer are there."""
    ids = spark.range(4000)
    team = distinct_numbers("t", F.lit(2), F.lit(5), F.col("id"))
    sets = Counter(tuple(sorted(r[0])) for r in ids.select(team).collect())
    assert len(sets) == 10 and all(len(set(s)) == 2 and min(s) >= 1 and max(s) <= 5 for s in sets)
    assert all(300 < n < 500 for n in sets.values())
    far = distinct_numbers("t", F.lit(3), F.lit(10**12), F.col("id"))
    gaps = [max(r[0]) - min(r[0]) for r in ids.select(far).collect()]
    assert max(gaps) > 0.9e12 and min(gaps) < 0.2e12
    few = ids.limit(3).select(*[distinct_numbers("t", F.lit(4), F.lit(n), F.col("id")) for n in (0, 1, 3)])
    assert all(r[0] == [] and r[1] == [1] and sorted(r[2]) == [1, 2, 3] for r in few.collect())


def test_distinct_numbers_draw_each_number_once(spark):
    """A draw per number and one of the size, with the values that Floyd's sampling gives step by step."""
    ids = spark.range(200)
    size = whole("size", 0, 5, F.col("id"))
    team = distinct_numbers("t", size, F.lit(7).cast("bigint"), F.col("id"))
    frame = ids.select("id", team.alias("team"))
    analyzed = frame._jdf.queryExecution().analyzed().toString()
    assert analyzed.count("md5(") == 2

    def plain(row: int) -> list[int]:
        digest = lambda *parts: hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
        wanted, chosen = int(digest("size", row)[:8], 16) % 6, []
        for i in range(1, wanted + 1):
            drawn = int(digest("t", row, i)[:15], 16) % (7 - wanted + i) + 1
            chosen.append(7 - wanted + i if drawn in chosen else drawn)
        return chosen

    assert {r.id: r.team for r in frame.collect()} == {row: plain(row) for row in range(200)}


def test_mapping_without_contributors_is_empty(spark):
    nobody = synth.contributors(spark.range(0).withColumnRenamed("id", "rank"))
    assets = spark.range(3).select(F.col("id").cast("string").alias("asset_id"))
    assert synth.contributor_mapping(assets, nobody, 1, 4).collect() == []


def test_date_key_is_that_of_the_format(spark):
    days = spark.sql(
        "select explode(array(date'2024-02-29', date'9999-12-31', date'0001-01-01', date'1582-10-10', null,"
        " make_date(0, 3, 1), make_date(-44, 3, 15), make_date(12345, 6, 7))) as day"
    )
    wanted = F.date_format("day", "yyyyMMdd").cast("int")
    assert days.filter(~date_key(F.col("day")).eqNullSafe(wanted)).count() == 0
    assert days.filter(date_key(F.col("day")).isNull()).count() == 1
