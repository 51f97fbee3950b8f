"""Every registered query with its SQL twin, by name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import twins as s
from queries.roles import Roles
from tallybeat import constants as k
from tallybeat.operators import quality
from tallybeat.operators.conform import conform, reject_counts, rejects, unparsed_counts
from tallybeat.operators.dedupe import one_per_minute
from tallybeat.operators.joins import lookup
from tallybeat.operators.ranking import seeded_sample
from tallybeat.plans import dims, facts, ingest, kpis, silver, streams, synth
from tallybeat.session import run_dir
from tallybeat.sources import files, landings, tables
from tallybeat.streaming import ingest as stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def edge(rows: DataFrame, digits: int = 6) -> DataFrame:
    """Types both engines show alike: amounts as doubles, days and instants as text."""

    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = F.round(value, digits) if field.dataType.scale > digits else value
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return value.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            return value.cast("bigint").alias(field.name)
        return value

    return rows.select(*[plain(field) for field in rows.schema])


def query(
    sql: str | None = None, digits: int = 6, name: str | None = None
) -> Callable[[Callable[[Roles], DataFrame]], Query]:
    """Register a function of the roles, under its own name unless another is given."""

    def register(make: Callable[[Roles], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return edge(make(Roles(spark, folder)), digits)

        key = name or make.__name__
        QUERIES[key] = run
        if sql:
            TWINS[key] = sql
        return run

    return register


# Conform -----------------------------------------------------------------------------------


@query("""
SELECT cast(s_suppkey AS varchar) AS distributor_id, trim(s_name) AS distributor_name,
       CASE WHEN s_nationkey % 2 = 0 THEN 'Monthly' ELSE 'Weekly' END AS payment_cycle,
       CASE WHEN s_acctbal > 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS active_status
FROM supplier""")
def conform_reference(r: Roles) -> DataFrame:
    return r.distributors()


CHANNELS = f"""channels AS ({s.first_of('''(
  SELECT cast(s_nationkey AS varchar) AS channel_id, trim(s_name) AS channel_name,
         'team '||(s_suppkey % 5) AS owner_team,
         ''' + s.date_of("printf('2020-%02d-%02d', s_suppkey % 14, s_suppkey % 28 + 1)") + ''' AS created_date,
         'ACTIVE' AS active_status FROM supplier)''',
    "channel_id", "channel_name, owner_team, created_date, active_status")})"""


@query(f"WITH {CHANNELS} SELECT * FROM channels")
def conform_channels(r: Roles) -> DataFrame:
    return conform(r.raw_channels(), silver.CHANNELS)


@query(s.first_of(
    """(SELECT p_brand AS artist_id, trim(p_name) AS artist_name, cast(p_partkey % 7 AS varchar) AS distributor_id,
               p_type AS label_name, p_type AS project_name, upper(p_type) AS active_status, """
    + s.date_of("printf('2021-%02d-15', p_size % 15)")
    + " AS created_date FROM part WHERE p_size <> 1)",
    "artist_id",
    "artist_name, distributor_id, label_name, project_name, active_status, created_date",
))
def conform_artists(r: Roles) -> DataFrame:
    return conform(r.raw_artists(), silver.ARTISTS)


@query(f"""
SELECT cast(p_partkey AS varchar) AS track_id, trim(p_name) AS track_title, 'T'||p_partkey AS asset_id,
       'XX-'||p_size AS isrc, cast(p_partkey AS varchar) AS recording_mbid, p_brand AS release_mbid,
       p_brand AS release_name, p_brand AS artist_id, cast(p_partkey % 7 AS varchar) AS distributor_id,
       p_type AS label_name, p_name AS project_name,
       {s.date_of("printf('2022-%02d-%02d', p_size % 13, p_size % 28 + 1)")} AS release_date,
       CASE WHEN p_type = 'PROMO' THEN 'INACTIVE' ELSE 'ACTIVE' END AS active_status
FROM part""")
def conform_tracks(r: Roles) -> DataFrame:
    return r.tracks()


@query("WITH " + s.RATES + """
SELECT country, cast(n_name AS varchar) AS country_name, cast(rate_per_view_usd AS double) AS rate_per_view_usd,
       '2024-01-01' AS effective_from, '2024-12-31' AS effective_to
FROM rates JOIN nation ON country = upper(n_name)""")
def conform_rates(r: Roles) -> DataFrame:
    return r.rates()


@query("""
SELECT asset_id, contributor_id, role_in_asset, 'EQUAL' AS allocation_method,
       cast(cast(allocation_percent AS decimal(9,6)) AS double) AS allocation_percent
FROM (""" + s.first_of(
    """(SELECT 'T'||l_partkey AS asset_id, cast(l_suppkey AS varchar) AS contributor_id,
               l_returnflag AS role_in_asset, cast(l_tax AS decimal(9,6)) AS allocation_percent FROM lineitem)""",
    "asset_id, contributor_id",
    "role_in_asset, allocation_percent",
) + ")")
def conform_mapping(r: Roles) -> DataFrame:
    return r.mapping()


@query(f"WITH {s.VIEWS} SELECT * FROM views")
def conform_views(r: Roles) -> DataFrame:
    return r.views()


REVENUE_EDGE = f"""streams, {s.num("revenue_original")} AS revenue_original, currency,
       {s.num("exchange_rate")} AS exchange_rate, {s.num("revenue_usd")} AS revenue_usd"""


@query(f"""WITH {s.REVENUE}
SELECT report_month, distributor_id, platform_id, artist_id, track_id, country, {REVENUE_EDGE} FROM revenue""")
def conform_partner_revenue(r: Roles) -> DataFrame:
    return r.partner_revenue()


@query(f"""WITH {s.RAW_REVENUE}
SELECT CASE WHEN track_id IS NULL THEN 'track_id missing'
            WHEN streams IS NULL OR streams < 0 THEN 'streams missing or negative'
            WHEN revenue_original IS NULL OR revenue_original < 0 THEN 'revenue_original missing or negative'
            ELSE 'accepted' END AS reject_reason, count(*) AS row_count
FROM raw_revenue GROUP BY ALL""")
def conform_reject_counts(r: Roles) -> DataFrame:
    return reject_counts(r.raw_partner_revenue(), silver.PARTNER_REVENUE)


@query(f"""WITH {s.RAW_REVENUE}
SELECT report_month, distributor_id, platform_id, artist_id, track_id, country, {REVENUE_EDGE},
       CASE WHEN track_id IS NULL THEN 'track_id missing'
            ELSE 'revenue_original missing or negative' END AS reject_reason
FROM raw_revenue WHERE track_id IS NULL OR revenue_original < 0""")
def conform_rejects(r: Roles) -> DataFrame:
    return rejects(r.raw_partner_revenue(), silver.PARTNER_REVENUE)


@query("""
SELECT 'created_date' AS column_name,
       count(*) FILTER (WHERE try_strptime(printf('2021-%02d-15', p_size % 15), '%Y-%m-%d') IS NULL) AS unparsed
FROM part""")
def conform_unparsed(r: Roles) -> DataFrame:
    return unparsed_counts(r.raw_artists(), silver.ARTISTS)


# Streams -----------------------------------------------------------------------------------

REPEATED = s.LISTENS + """, repeated AS (
  SELECT * FROM listens UNION ALL
  SELECT user_id, recording_mbid, listened_at + INTERVAL 20 SECOND, event_id FROM listens
  WHERE cast(recording_mbid AS int) < 33)"""


@query(f"""WITH {REPEATED}
SELECT user_id, recording_mbid,
       strftime(date_trunc('minute', listened_at), '%Y-%m-%d %H:%M:%S.%f') AS listen_minute,
       strftime(min(listened_at), '%Y-%m-%d %H:%M:%S.%f') AS listened_at
FROM repeated GROUP BY user_id, recording_mbid, date_trunc('minute', listened_at)""")
def dedupe_minute(r: Roles) -> DataFrame:
    return one_per_minute(r.repeated_listens())


@query(f"WITH {s.STREAMS} SELECT * FROM streams")
def stream_monthly(r: Roles) -> DataFrame:
    return streams.stream_monthly(r.listens(), r.tracks())


@query(f"WITH {s.STREAMS} SELECT * FROM streams ORDER BY stream_count DESC, listen_month, recording_mbid LIMIT 10")
def kpi_top_streams(r: Roles) -> DataFrame:
    return kpis.top_streams(streams.stream_monthly(r.listens(), r.tracks()))


@query(f"""WITH {s.LISTENS}
SELECT count(*) AS active_tracks, count(h.recording_mbid) AS heard_tracks
FROM part LEFT JOIN (SELECT DISTINCT recording_mbid FROM listens) h
  ON h.recording_mbid = cast(p_partkey AS varchar) WHERE p_type <> 'PROMO'""")
def active_members(r: Roles) -> DataFrame:
    return streams.active_members(r.listens(), r.tracks())


# Dimensions --------------------------------------------------------------------------------


@query("""
SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
       day(d) AS day, week(d) AS week, month(d) AS month, quarter(d) AS quarter, year(d) AS year,
       monthname(d) AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)""")
def dim_date(r: Roles) -> DataFrame:
    bounds = r.table("lineitem").agg(
        F.min("l_shipdate").cast("date").alias("start"), F.max("l_shipdate").cast("date").alias("end")
    )
    return dims.dim_date(bounds)


@query(f"WITH {CHANNELS} SELECT * FROM channels")
def dim_passthrough(r: Roles) -> DataFrame:
    name = f"{namespace(r.spark)}.youtube_channels"
    tables.write_table(conform(r.raw_channels(), silver.CHANNELS), name)
    return r.spark.table(name)


@query(f"""
SELECT 'V'||p_partkey AS asset_id, 'VIDEO' AS asset_type, p_name AS asset_title, 'VID'||p_partkey AS video_id,
       cast(NULL AS varchar) AS track_id, cast(NULL AS varchar) AS recording_mbid, cast(NULL AS varchar) AS release_mbid,
       cast(p_partkey % 25 AS varchar) AS channel_id, cast(NULL AS varchar) AS artist_id,
       cast(NULL AS varchar) AS distributor_id, p_name AS project_name, cast(NULL AS varchar) AS label_name,
       {s.date_of("printf('2023-%02d-%02d', p_size % 13, p_size % 28 + 1)")} AS release_date, 'ACTIVE' AS active_status
FROM part WHERE p_type <> 'PROMO'
UNION ALL
SELECT 'T'||p_partkey, 'TRACK', p_name, NULL, cast(p_partkey AS varchar), cast(p_partkey AS varchar), p_brand, NULL,
       p_brand, cast(p_partkey % 7 AS varchar), p_name, p_type,
       {s.date_of("printf('2022-%02d-%02d', p_size % 13, p_size % 28 + 1)")},
       CASE WHEN p_type = 'PROMO' THEN 'INACTIVE' ELSE 'ACTIVE' END
FROM part""")
def dim_asset(r: Roles) -> DataFrame:
    return dims.dim_content_asset(r.videos(), r.tracks())


# Facts -------------------------------------------------------------------------------------


@query(f"""WITH {s.VIEW_FACT}
SELECT date_key, asset_id, video_id, channel_id, country, views, {s.num("rate_per_view_usd")} AS rate_per_view_usd,
       {s.num("youtube_revenue_usd")} AS youtube_revenue_usd FROM view_fact""")
def fact_view_revenue(r: Roles) -> DataFrame:
    return r.view_revenue()


@query(f"""WITH {s.VIEW_FACT}
SELECT country, n_regionkey NOT IN (2, 4) OR views < 45 AS kept, count(*) AS row_count,
       CASE WHEN n_regionkey IN (2, 4) AND views >= 45 THEN '{facts.TOO_LARGE}' END AS reject_reason
FROM view_fact JOIN nation ON country = upper(n_name) GROUP BY ALL""")
def fact_view_rejects(r: Roles) -> DataFrame:
    """Absurd counts at raised rates: amounts the money type cannot hold go to the rejects, the rest stays."""
    absurd = F.when(F.col("views") >= 45, F.lit(9 * 10**18)).otherwise(F.col("views")).alias("views")
    views = r.views().select("view_date", "video_id", "country", absurd)
    dear = r.rates().withColumn("rate_per_view_usd", (F.col("rate_per_view_usd") * 10_000).cast(k.VIEW_RATE))
    kept = facts.view_revenue_daily(views, dear, r.videos()).withColumn("reject_reason", F.lit(None).cast("string"))
    refused = facts.view_revenue_rejects(views, dear, r.videos())
    sides = [
        side.select("country", "reject_reason", F.lit(stays).alias("kept"))
        for side, stays in ((kept, True), (refused, False))
    ]
    return sides[0].unionByName(sides[1]).groupBy("country", "kept", "reject_reason").agg(F.count("*").alias("row_count"))


@query(f"""WITH {s.VIEWS}, periods AS (
  SELECT upper(n_name) AS country, year, make_date(year, 1, 1) AS begins,
         CASE WHEN year < 2000 THEN least(make_date(year + 2, 1, 1) - 1,
              CASE WHEN n_regionkey = 1 THEN make_date(year + 2, 12, 31) ELSE make_date(year + 1, 6, 30) END) END AS ends,
         cast(0.0005 * (n_regionkey + year - 1995) AS decimal(12,8)) AS rate
  FROM nation, (VALUES (1996), (1998), (2000)) y(year) WHERE n_regionkey <> 3),
days AS (SELECT view_date[:4] AS view_year, view_date::date AS day, country, views FROM views
         JOIN part ON video_id = 'VID'||p_partkey AND p_type <> 'PROMO')
SELECT d.country, view_year, cast(sum(views) AS bigint) AS views, count(rate) AS rated_rows,
       {s.num("sum(cast(cast(views AS decimal(30,0)) * rate AS decimal(18,8)))")} AS youtube_revenue_usd
FROM days d LEFT JOIN periods p ON d.country = p.country AND d.day >= p.begins AND (p.ends IS NULL OR d.day <= p.ends)
GROUP BY ALL""")
def fact_view_revenue_by_validity(r: Roles) -> DataFrame:
    """Rates in force on the day of the view: periods with gaps, overlaps (region 1) and an open end."""
    periods = conform(r.raw_rate_periods(), silver.RATE_PERIODS)
    fact = facts.view_revenue_daily(r.views(), periods, r.videos(), by_validity=True)
    return fact.groupBy("country", F.substring(F.col("date_key").cast("string"), 1, 4).alias("view_year")).agg(
        F.sum("views").alias("views"),
        F.count("rate_per_view_usd").alias("rated_rows"),
        F.sum("youtube_revenue_usd").alias("youtube_revenue_usd"),
    )


@query(f"""WITH {s.PARTNER_FACT}
SELECT month_key, asset_id, track_id, artist_id, distributor_id, platform_id, country, {REVENUE_EDGE}
FROM partner_fact""")
def fact_partner_revenue(r: Roles) -> DataFrame:
    return r.partner_fact()


@query(f"WITH {s.UNIFIED} SELECT * EXCLUDE (revenue_usd), {s.num('revenue_usd')} AS revenue_usd FROM unified")
def fact_unified(r: Roles) -> DataFrame:
    return r.unified()


ASSET_REVENUE = f"""WITH {s.ASSET_REVENUE}
SELECT revenue_period, period_type, source_type, asset_id, {s.num("revenue_usd")} AS revenue_usd FROM asset_revenue"""


@query(ASSET_REVENUE)
def asset_revenue(r: Roles) -> DataFrame:
    return facts.asset_revenue(r.unified())


@query(f"""WITH {s.ALLOCATION}
SELECT revenue_period, period_type, source_type, asset_id, contributor_id, role_in_asset,
       {s.num("revenue_usd")} AS revenue_usd, {s.num("allocation_percent")} AS allocation_percent,
       {s.num("allocated_revenue_usd")} AS allocated_revenue_usd FROM allocation""")
def contributor_revenue(r: Roles) -> DataFrame:
    return r.allocation()


# Reports -----------------------------------------------------------------------------------


@query(f"WITH {s.UNIFIED} SELECT {s.num('sum(revenue_usd)', 4)} AS revenue_usd FROM unified", digits=4)
def kpi_total(r: Roles) -> DataFrame:
    return kpis.total_revenue(r.unified())


@query(
    f"""WITH {s.UNIFIED}
SELECT source_type, {s.num("sum(revenue_usd)", 4)} AS revenue_usd FROM unified GROUP BY source_type""",
    digits=4,
)
def kpi_by_source(r: Roles) -> DataFrame:
    return kpis.revenue_by_source(r.unified())


@query(
    f"""WITH {s.PARTNER_FACT}
SELECT month_key, cast(sum(streams) AS bigint) AS total_streams, {s.num("sum(revenue_usd)", 4)} AS total_revenue
FROM partner_fact GROUP BY month_key""",
    digits=4,
)
def kpi_by_month(r: Roles) -> DataFrame:
    return kpis.partner_revenue_by_month(r.partner_fact())


TOP_CONTRIBUTORS = f"""WITH {s.ALLOCATION}
SELECT contributor_id, {s.num("total", 4)} AS total_allocated FROM (
  SELECT contributor_id, sum(allocated_revenue_usd) AS total FROM allocation GROUP BY contributor_id)
ORDER BY total DESC, contributor_id LIMIT 10"""


@query(TOP_CONTRIBUTORS, digits=4)
def kpi_top_contributors(r: Roles) -> DataFrame:
    return kpis.top_contributors(r.allocation())


@query(TOP_CONTRIBUTORS, digits=4)
def kpi_top_contributors_by_asset(r: Roles) -> DataFrame:
    return kpis.top_contributors_from_assets(r.unified(), tables.staged(r.shares(), "shares"))


@query(
    f"""WITH {s.REVENUE}, {s.VIEWS}
SELECT (SELECT cast(sum(streams) AS bigint) FROM revenue) AS total_streams,
       (SELECT {s.num("sum(revenue_original)", 4)} FROM revenue) AS total_revenue_original,
       (SELECT cast(sum(views) AS bigint) FROM views) AS total_views""",
    digits=4,
)
def table_totals(r: Roles) -> DataFrame:
    return kpis.table_totals(r.partner_revenue(), r.views())


@query(
    "SELECT table_name, row_count FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    + ") UNION ALL SELECT 'TOTAL', cast(sum(n) AS bigint) FROM ("
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in TABLES)
    + ")"
)
def table_counts(r: Roles) -> DataFrame:
    return quality.count_tables({name: r.table(name) for name in TABLES})


@query("""
SELECT count(*) AS mapping_rows, count(DISTINCT a) AS assets, count(*) / count(DISTINCT a) AS contributors_per_asset
FROM (SELECT DISTINCT l_partkey AS a, l_suppkey AS c FROM lineitem)""")
def contributors_per_asset(r: Roles) -> DataFrame:
    return kpis.contributors_per_asset(r.mapping())


# Pools, lookups, samples ---------------------------------------------------------------------

POOL = """(SELECT lang||'/'||source AS recording_mbid, 'doc ' AS recording_name, lang AS artist_name,
  cast(n_chars AS varchar) AS release_name, cast(doc_id AS varchar) AS release_mbid, doc_id FROM documents)"""
CREDITS = """(SELECT doc_id, lang AS artist_name, unnest(string_split(text, ' ')) AS artist_id,
  generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents)"""


@query(f"SELECT * EXCLUDE (doc_id) FROM ({s.first_of(POOL, 'recording_mbid', 'doc_id')})")
def first_seen_pool(r: Roles) -> DataFrame:
    return synth.recording_pool(r.words())


@query(f"""SELECT artist_id, artist_name FROM (
{s.first_of(f"(SELECT * FROM {CREDITS} WHERE artist_id <> '')", "artist_id", "doc_id, pos")})""")
def exploded_pool(r: Roles) -> DataFrame:
    return synth.artist_pool(r.words())


@query(f"""SELECT 'recordings' AS pool, count(DISTINCT recording_mbid) AS ids FROM {POOL}
UNION ALL SELECT 'artists', count(DISTINCT artist_id) FROM {CREDITS} WHERE artist_id <> ''""")
def pool_sizes(r: Roles) -> DataFrame:
    words = r.words()
    return synth.pool_sizes(synth.recording_pool(words), synth.artist_pool(words))


@query("""SELECT c_custkey, c_name, c_nationkey, n_name, n_regionkey
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def lookup_enrich(r: Roles) -> DataFrame:
    customers = r.table("customer").select("c_custkey", "c_name", "c_nationkey")
    nations = r.table("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup(customers, nations, "c_nationkey", ["n_name", "n_regionkey"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders
ORDER BY md5('sample|'||o_orderkey), o_orderkey LIMIT 3000""",
    name="seeded_sample",
)
def sampled_orders(r: Roles) -> DataFrame:
    pool = r.table("orders").select("o_orderkey", "o_custkey")
    return seeded_sample(pool, "o_orderkey", k.TRACK_COUNT, "sample")


# Generated data ----------------------------------------------------------------------------


@query(f"""WITH {s.ARTISTS} SELECT * EXCLUDE (created_date), cast(created_date AS varchar) AS created_date
FROM artists""")
def synth_artists(r: Roles) -> DataFrame:
    return r.synth_artists()


@query(f"""WITH {s.SYNTH_TRACKS} SELECT * EXCLUDE (release_date), cast(release_date AS varchar) AS release_date
FROM synth_tracks""")
def synth_tracks(r: Roles) -> DataFrame:
    return r.synth_tracks()


@query(f"""SELECT rank, printf('CTB%03d', rank) AS contributor_id, 'Nghệ sĩ '||printf('%03d', rank) AS contributor_name,
  {s.choice("42.contributor.team", k.TEAMS, "rank")} AS team,
  {s.choice("42.contributor.role", k.ROLES, "rank")} AS default_role,
  {s.status("42.contributor.status", 90, "rank")} AS active_status
FROM (SELECT s_suppkey + 1 AS rank FROM supplier)""")
def synth_contributors(r: Roles) -> DataFrame:
    return r.people()


@query(f"""SELECT rank, printf('CHN%03d', rank) AS channel_id, printf('Channel %03d', rank) AS channel_name,
  {s.choice("42.channel.team", k.TEAMS, "rank")} AS owner_team,
  cast({s.day("42.channel.created", "2019-01-01", "2022-12-31", "rank")} AS varchar) AS created_date,
  'ACTIVE' AS active_status
FROM (SELECT s_suppkey + 1 AS rank FROM supplier)""")
def synth_channels(r: Roles) -> DataFrame:
    return synth.channels(r.spine("supplier", "s_suppkey"))


@query(f"""WITH {s.SYNTH_VIDEOS} SELECT * EXCLUDE (upload_date), cast(upload_date AS varchar) AS upload_date
FROM synth_videos""")
def synth_videos(r: Roles) -> DataFrame:
    return r.synth_videos()


@query(f"""WITH {s.ROLE_SHARES}
SELECT * EXCLUDE (allocation_percent), {s.num("allocation_percent")} AS allocation_percent FROM shares""")
def synth_mapping(r: Roles) -> DataFrame:
    return r.shares()


@query(f"""WITH {s.SYNTH_REVENUE}
SELECT * EXCLUDE (revenue_original, exchange_rate), {s.num("revenue_original")} AS revenue_original,
       {s.num("exchange_rate")} AS exchange_rate FROM synth_revenue""")
def synth_revenue(r: Roles) -> DataFrame:
    return synth.partner_revenue(r.synth_tracks())


@query(f"""WITH {s.SYNTH_VIEWS}
SELECT video_id, country, count(*) AS days, min(view_date) AS first_day, max(view_date) AS last_day,
       cast(sum(views) AS bigint) AS views, max(views) AS most FROM synth_views GROUP BY video_id, country""")
def synth_views(r: Roles) -> DataFrame:
    """Views per video and country."""
    return (
        synth.daily_views(r.synth_videos())
        .groupBy("video_id", "country")
        .agg(
            F.count("*").alias("days"),
            F.min("view_date").alias("first_day"),
            F.max("view_date").alias("last_day"),
            F.sum("views").alias("views"),
            F.max("views").alias("most"),
        )
    )


@query(f"WITH {s.SYNTH_VIEWS} SELECT view_date, video_id, country, views FROM synth_views")
def synth_views_by_day(r: Roles) -> DataFrame:
    """Every generated row of views."""
    return synth.daily_views(r.synth_videos())


@query(f"""WITH {s.SYNTH_REVENUE}
SELECT r.country, any_value(n.country_name) AS country_name, count(*) AS row_count, cast(sum(streams) AS bigint) AS streams
FROM synth_revenue r JOIN (VALUES {", ".join(f"('{c}', '{n}')" for c, n, *_ in k.COUNTRIES)}) n(country, country_name)
  USING (country) GROUP BY r.country""")
def synth_revenue_by_country(r: Roles) -> DataFrame:
    """Partner revenue against the fixed country table."""
    revenue = synth.partner_revenue(r.synth_tracks())
    totals = revenue.groupBy("country").agg(
        F.count("*").alias("row_count"), F.sum("streams").alias("streams")
    )
    return lookup(totals, synth.rates(r.spark), "country", ["country_name"])


# Files and ingest ----------------------------------------------------------------------------


#: Files of a delivery; file i holds the events whose id leaves i.
DELIVERED = 8


def deliver(r: Roles, path: str | None = None) -> str:
    """Events as a folder of numbered Parquet files."""
    path = path or run_dir(r.spark, "delivery")
    place = (F.col("event_id") % DELIVERED).cast("int")
    r.table("events").repartitionById(DELIVERED, place).write.parquet(path)
    return path


def namespace(spark: SparkSession) -> str:
    """A new namespace in the shared folder."""
    name = f"tb_{uuid.uuid4().hex[:12]}"
    tables.create_namespace(spark, name, run_dir(spark, name))
    return name


@query(
    " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, count(*) AS row_count FROM {t}" for t in TABLES)
)
def rows_per_file(r: Roles) -> DataFrame:
    return files.rows_per_file(r.spark, r.folder)


@query("""SELECT prefix, files, true AS has_bytes FROM (VALUES ('listens', 8), ('orders', 4), ('TOTAL', 12)) v(prefix, files)
WHERE (SELECT count(*) FROM events) > 0 AND (SELECT count(*) FROM orders) > 0""")
def bronze_inventory(r: Roles) -> DataFrame:
    target = run_dir(r.spark, "bronze")
    deliver(r, f"{target}/listens")
    files.write_csv(r.table("orders").repartition(4), f"{target}/orders")
    usage = quality.prefix_usage(files.list_files(r.spark, target))
    return usage.select("prefix", "files", (F.col("bytes") > 0).alias("has_bytes"))


@query("SELECT DISTINCT event_id % 8 AS file_no FROM events")
def numeric_file_order(r: Roles) -> DataFrame:
    return files.numbered(files.list_files(r.spark, deliver(r), "*.parquet")).select("file_no")


@query("""SELECT event_id % 8 AS file_no, count(*) AS row_count, min(event_id) AS first_event, max(event_id) AS last_event
FROM events WHERE event_id % 8 < 3 GROUP BY ALL""")
def first_n_files(r: Roles) -> DataFrame:
    first = files.first_files(r.spark, deliver(r), 3, ["event_id", "user_id"])
    return first.groupBy("file_no").agg(
        F.count("*").alias("row_count"),
        F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"),
    )


@query("""SELECT run, 'LOADED' AS status, n AS landed_rows FROM (VALUES (1), (2)) v(run), (SELECT count(*) AS n FROM events)""")
def bronze_ingest(r: Roles) -> DataFrame:
    """Two runs over one delivery: the second finds nothing new and adds nothing."""
    source, target = deliver(r), run_dir(r.spark, "bronze")
    runs = [
        tables.staged(ingest.outcome(ingest.ingest(r.spark, source, target, "2024-02-01")), "outcome").select(
            F.lit(run).alias("run"), "status", "landed_rows"
        )
        for run in (1, 2)
    ]
    return runs[0].unionByName(runs[1])


@query("""SELECT '2024-02-01' AS ingested_date, event_id % 8 AS file_no, true AS has_bytes, count(*) AS landed_rows,
  'LOADED' AS status FROM events GROUP BY ALL""")
def ingest_manifest(r: Roles) -> DataFrame:
    entries = ingest.ingest(r.spark, deliver(r), run_dir(r.spark, "bronze"), "2024-02-01")
    has_bytes = (F.col("bytes") > 0).alias("has_bytes")
    return entries.select("ingested_date", "file_no", has_bytes, "landed_rows", "status")


@query("""SELECT CASE WHEN event_id % 8 = 3 THEN 'DIFFERENT' ELSE 'OK' END AS status,
  count(DISTINCT event_id % 8) AS files, count(*) AS expected_rows, count(*) AS found_rows FROM events GROUP BY ALL
UNION ALL SELECT 'MISSING', 1, 7, 0 UNION ALL SELECT 'EXTRA', 1, 0, 5""")
def reconcile_ingest(r: Roles) -> DataFrame:
    """Source against target by content: a file changed in one value since, one too many, one that never landed."""
    source, target, date = deliver(r), run_dir(r.spark, "bronze"), "2024-02-01"
    events = r.table("events")
    schema = events.schema
    ingest.ingest(r.spark, source, target, date)
    landed = files.read_listens(r.spark, target, date, T.StructType([*schema, *landings.ORIGIN]))
    file_no = files.leading_number(F.col("source_file"))
    # Planted: of the file that holds the third eighth, one row's value is another now.
    last = landed.filter(file_no == 3).agg(F.max("event_id")).first()[0]
    changed = landed.withColumn("value", F.when(F.col("event_id") == last, F.col("value") + 1).otherwise(F.col("value")))
    stray = events.limit(5).select("*", F.lit("stray.parquet").alias("source_file"), F.lit(0).cast("bigint").alias("source_row"))
    found = changed.drop("ingested_date").unionByName(stray)
    given = r.spark.read.schema(schema).parquet(source).select("*", F.col("_metadata.file_name").alias("source_file"))
    late = events.limit(7).withColumn("source_file", F.lit("late.parquet"))
    status = quality.reconcile_content(given.unionByName(late), found, "source_file", schema.names)
    return status.groupBy("status").agg(
        F.count("*").alias("files"),
        F.sum("expected_rows").alias("expected_rows"),
        F.sum("found_rows").alias("found_rows"),
    )


@query("SELECT '2024-02-01' AS ingested_date, count(*) AS landed_rows FROM events")
def stream_landing(r: Roles) -> DataFrame:
    """The streaming form of the ingest, run twice over one delivery."""
    source, target, checkpoint = deliver(r), run_dir(r.spark, "bronze"), run_dir(r.spark, "checkpoint")
    for _ in range(2):
        stream_ingest.land_new_files(
            r.spark, source, target, checkpoint, "2024-02-01", r.table("events").schema, files_per_batch=4
        )
    landed = stream_ingest.landed_rows(r.spark, target)
    return landed.groupBy(F.col("ingested_date").cast("string").alias("ingested_date")).agg(
        F.sum("landed_rows").alias("landed_rows")
    )


@query("""SELECT event_type, count(*) AS row_count FROM events
WHERE ts::date = DATE '2024-01-15' GROUP BY event_type""")
def partition_scan(r: Roles) -> DataFrame:
    """One ingest date out of a folder partitioned by it."""
    path = run_dir(r.spark, "listens")
    dated = r.table("events").withColumn("ingested_date", F.date_format("ts", "yyyy-MM-dd"))
    dated.hint("rebalance", "ingested_date").write.partitionBy("ingested_date").parquet(path)
    one = files.read_listens(r.spark, path, "2024-01-15", r.table("events").schema)
    return one.groupBy("event_type").agg(F.count("*").alias("row_count"))


@query("""
SELECT event_id AS feedback_id, user_id, event_type AS recording_msid,
       CASE WHEN cast(json_extract_string(props, '$.k') AS int) >= 30 THEN json_extract_string(props, '$.k') END AS recording_mbid,
       CASE WHEN value > 10 THEN 1 ELSE -1 END AS score,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM events""")
def tsv_feedback(r: Roles) -> DataFrame:
    """Events as a feedback dump, written and read back."""
    recording = F.get_json_object("props", "$.k")
    path = run_dir(r.spark, "feedback")
    r.table("events").select(
        F.col("event_id").cast("int"),
        F.col("user_id").cast("int"),
        "event_type",
        F.when(recording.cast("int") >= 30, recording),
        F.when(F.col("value") > 10, 1).otherwise(-1),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
    ).write.option("delimiter", "\t").option("nullValue", "\\N").csv(path)
    return files.read_feedback(r.spark, path)


@query("SELECT cast(doc_id AS varchar) AS doc_id, md5(text) AS text_md5, length(text) AS chars, lang FROM documents")
def csv_roundtrip(r: Roles) -> DataFrame:
    """Whole documents, line breaks and quotes included, through CSV."""
    path = run_dir(r.spark, "documents")
    files.write_csv(r.table("documents").select("doc_id", "text", "lang"), path)
    back = files.read_csv(r.spark, path, free_text=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"), "lang")


# Tables and reports about them -----------------------------------------------------------------


@query("""SELECT row_number() OVER () AS position, column_name,
  CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS column_type
FROM (DESCRIBE orders)""")
def schema_report(r: Roles) -> DataFrame:
    return quality.schema_report(r.table("orders"))


LINEITEM = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


TYPE_NAMES = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS column_type"""


@query(
    f"SELECT position, column_name, column_type, non_null FROM (SELECT column_name, {TYPE_NAMES} FROM (DESCRIBE lineitem)) JOIN ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS non_null FROM lineitem"
        for i, c in enumerate(LINEITEM, 1)
    )
    + ") USING (column_name)"
)
def table_profile(r: Roles) -> DataFrame:
    return quality.profile(r.table("lineitem"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderkey").limit(5)


@query(ASSET_REVENUE)
def staged_write(r: Roles) -> DataFrame:
    return tables.staged(facts.asset_revenue(r.unified()), "asset_revenue")


ORDERS_BY_MONTH = """SELECT strftime(o_orderdate, '%Y%m') AS month_key, count(*) AS orders,
  (SELECT count(*) FROM orders) AS written FROM orders GROUP BY ALL"""


@query(ORDERS_BY_MONTH)
def partitioned_write(r: Roles) -> DataFrame:
    name = f"{namespace(r.spark)}.orders_by_month"
    dated = r.table("orders").withColumn("month_key", F.date_format("o_orderdate", "yyyyMM"))
    written = tables.write_table(dated, name, "month_key")
    return (
        r.spark.table(name)
        .groupBy("month_key")
        .agg(F.count("*").alias("orders"))
        .withColumn("written", F.lit(written))
    )


@query("SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL")
def replaced_table(r: Roles) -> DataFrame:
    """The second write of a name wins, the first is gone."""
    name = f"{namespace(r.spark)}.orders"
    tables.write_table(r.table("orders"), name)
    tables.write_table(r.table("orders").filter(F.col("o_orderstatus") != "P"), name)
    return r.spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@query(f"""WITH {s.ASSET_REVENUE}
SELECT source_type, count(*) AS groups, (SELECT count(*) FROM asset_revenue) AS all_groups
FROM asset_revenue GROUP BY source_type""")
def cached_reuse(r: Roles) -> DataFrame:
    with tables.cached(facts.asset_revenue(r.unified())) as (kept, count):
        by_source = kept.groupBy("source_type").agg(F.count("*").alias("groups"))
        return tables.staged(by_source.withColumn("all_groups", F.lit(count)), "by_source")


@query("SELECT strftime(o_orderdate, '%Y%m') AS month_key, count(*) AS orders FROM orders GROUP BY ALL")
def register_location(r: Roles) -> DataFrame:
    path = run_dir(r.spark, "files")
    dated = r.table("orders").withColumn("month_key", F.date_format("o_orderdate", "yyyyMM"))
    dated.hint("rebalance", "month_key").write.partitionBy("month_key").parquet(path)
    name = f"{namespace(r.spark)}.orders"
    tables.register_location(r.spark, name, path)
    return (
        r.spark.table(name)
        .groupBy(F.col("month_key").cast("string").alias("month_key"))
        .agg(F.count("*").alias("orders"))
    )


REGION_TABLES = "SELECT 'nations_' || lower(replace(r_name, ' ', '_')) AS table_name FROM region"


@query(REGION_TABLES)
def list_tables(r: Roles) -> DataFrame:
    """One table per region, found again by its name."""
    return tables.list_tables(r.spark, _region_tables(r)).select("table_name")


@query(f"SELECT * FROM ({REGION_TABLES}) WHERE contains(table_name, 'as') AND starts_with(table_name, 'nations_')")
def filtered_tables(r: Roles) -> DataFrame:
    return tables.list_tables(r.spark, _region_tables(r), contains="as", prefix="nations_").select("table_name")


@query(f"SELECT *, contains(table_name, 'a_') OR contains(table_name, 'am') AS gone FROM ({REGION_TABLES})")
def bulk_drop(r: Roles) -> DataFrame:
    """What two bulk drops by name leave of the tables, and what they report as gone."""
    name = _region_tables(r)
    gone = [n.split(".")[-1] for part in ("a_", "am") for n in tables.drop_tables(r.spark, name, part)]
    left = tables.list_tables(r.spark, name).select("table_name", F.lit(False).alias("gone"))
    return left.unionByName(r.spark.createDataFrame([(n, True) for n in gone], left.schema))


@query("SELECT 'of_' || lower(replace(r_name, ' ', '_')) AS namespace FROM region")
def list_namespaces(r: Roles) -> DataFrame:
    """A namespace per region, made twice without harm and listed."""
    tag = uuid.uuid4().hex[:12]
    for row in r.table("region").select("r_name").collect():  # five names
        for _ in range(2):
            name = f"t{tag}_of_{_plain_name(row.r_name)}"
            tables.create_namespace(r.spark, name, run_dir(r.spark, name))
    listed = tables.list_namespaces(r.spark).filter(F.col("namespace").startswith(f"t{tag}_"))
    return listed.select(F.substr("namespace", F.lit(len(tag) + 3)).alias("namespace"))


@query("""SELECT status, count(o_orderkey) > 0 AS there FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(status)
LEFT JOIN orders ON o_orderstatus = status GROUP BY status""")
def required_paths(r: Roles) -> DataFrame:
    """Which folders of a partitioned delivery pass the precondition of a job."""
    path = run_dir(r.spark, "orders")
    r.table("orders").hint("rebalance", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)

    def there(status: str) -> bool:
        try:
            ingest.require_path(r.spark, f"{path}/o_orderstatus={status}")
        except FileNotFoundError:
            return False
        return True

    return r.spark.createDataFrame([(status, there(status)) for status in "FOPX"], "status string, there boolean")


@query("""SELECT 'OK' AS status, count(*) AS row_count, 'dim_nation' AS table_name FROM nation
UNION ALL SELECT 'ERROR', NULL, 'missing' UNION ALL SELECT 'OK', count(*), 'TOTAL' FROM nation""")
def tolerant_counts(r: Roles) -> DataFrame:
    """A missing table is reported and does not stop the count."""
    name = _three_tables(r)
    report = quality.count_tables_tolerant(r.spark, [f"{name}.dim_nation", f"{name}.missing"])
    return report.withColumn("table_name", F.substring_index("table_name", ".", -1))


@query("""SELECT 'fact_orders' AS table_name, count(*) AS row_count, 'create' AS message FROM orders
UNION ALL SELECT 'dim_nation', count(*), 'create' FROM nation""")
def run_log(r: Roles) -> DataFrame:
    name = namespace(r.spark)
    for table, rows in (("fact_orders", r.table("orders")), ("dim_nation", r.table("nation"))):
        written = tables.write_table(rows, f"{name}.{table}")
        tables.log_write(r.spark, f"{name}.run_log", table, written, "create")
    return tables.latest_writes(r.spark, f"{name}.run_log").select("table_name", "row_count", "message")


def _plain_name(text: str) -> str:
    return text.lower().replace(" ", "_")


def _region_tables(r: Roles) -> str:
    """A namespace with the nations of each region as a table."""
    name = namespace(r.spark)
    for row in r.table("region").collect():  # five regions
        nations = r.table("nation").filter(F.col("n_regionkey") == row.r_regionkey)
        tables.write_table(nations, f"{name}.nations_{_plain_name(row.r_name)}")
    return name


def _three_tables(r: Roles) -> str:
    name = namespace(r.spark)
    tables.write_table(r.table("nation"), f"{name}.dim_nation")
    tables.write_table(r.table("orders"), f"{name}.fact_orders")
    tables.write_table(r.table("customer"), f"{name}.fact_customers")
    return name
