"""SQL building blocks of the twins, in DuckDB's dialect."""

from __future__ import annotations

from tallybeat import constants as k


def num(expression: str, digits: int = 6) -> str:
    """An exact amount at the edge: rounded, then one cast to double."""
    return f"cast(round({expression}, {digits}) as double)"


def draw(seed: str, *parts: str) -> str:
    text = "||'|'||".join([f"'{seed}'", *parts])
    return f"(('0x'||substr(md5({text}),1,8))::bigint)"


def whole(seed: str, low: int, high: int, *parts: str) -> str:
    return f"({low} + {draw(seed, *parts)} % {high - low + 1})"


def choice(seed: str, values: list[str], *parts: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"([{items}])[{whole(seed, 1, len(values), *parts)}]"


def status(seed: str, percent: int, key: str) -> str:
    return f"CASE WHEN {draw(seed, key)} % 100 < {percent} THEN 'ACTIVE' ELSE 'INACTIVE' END"


def day(seed: str, first: str, last: str, key: str) -> str:
    span = f"(date_diff('day', date '{first}', date '{last}') + 1)"
    return f"cast(date '{first}' + cast({draw(seed, key)} % {span} as int) as date)"


def first_of(source: str, keys: str, order: str) -> str:
    ordered = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {ordered}) AS rn FROM {source}) WHERE rn = 1"
    )


def date_of(text: str) -> str:
    return f"strftime(try_strptime({text}, '%Y-%m-%d'), '%Y-%m-%d')"


VIEWS = """views AS (
  SELECT view_date, video_id, country, min(views) AS views FROM (
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS view_date, 'VID'||l_partkey AS video_id,
           upper(n_name) AS country,
           CASE WHEN l_linenumber <> 7 THEN cast(l_quantity - 3 AS bigint) END AS views
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
  WHERE views >= 0 GROUP BY view_date, video_id, country)"""

RATES = """rates AS (
  SELECT upper(n_name) AS country,
         cast(cast(0.0005 AS decimal(8,4)) * (n_regionkey + 1) AS decimal(12,8)) AS rate_per_view_usd
  FROM nation WHERE n_regionkey <> 3)"""

RAW_REVENUE = """raw_revenue AS (
  SELECT *, cast(cast(revenue_original AS decimal(38,6)) * exchange_rate AS decimal(18,8)) AS revenue_usd FROM (
    SELECT strftime(o_orderdate, '%Y%m') AS report_month, cast(l_suppkey AS varchar) AS distributor_id,
           l_returnflag AS platform_id, o_orderstatus AS artist_id,
           CASE WHEN l_linenumber <> 7 THEN cast(l_partkey AS varchar) END AS track_id,
           upper(o_orderpriority) AS country, cast(l_quantity AS bigint) AS streams,
           cast(cast(l_extendedprice AS decimal(12,2)) - 2000 AS decimal(18,6)) AS revenue_original,
           'USD' AS currency,
           CASE WHEN cast(round(l_tax * 100) AS int) <> 8
                THEN cast(1 - cast(l_discount AS decimal(4,2)) AS decimal(18,10)) END AS exchange_rate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey))"""

REVENUE = (
    RAW_REVENUE
    + """, revenue AS ("""
    + first_of(
        "(SELECT * FROM raw_revenue WHERE track_id IS NOT NULL AND streams >= 0 AND revenue_original >= 0)",
        "report_month, distributor_id, platform_id, track_id, country",
        "artist_id, streams, revenue_original, currency, exchange_rate, revenue_usd",
    )
    + ")"
)

VIEW_FACT = (
    VIEWS
    + ", "
    + RATES
    + """, view_fact AS (
  SELECT cast(replace(view_date, '-', '') AS bigint) AS date_key, 'V'||p_partkey AS asset_id, video_id,
         cast(p_partkey % 25 AS varchar) AS channel_id, v.country, views, rate_per_view_usd,
         cast(cast(views AS decimal(30,0)) * rate_per_view_usd AS decimal(18,8)) AS youtube_revenue_usd
  FROM views v JOIN part ON v.video_id = 'VID'||p_partkey AND p_type <> 'PROMO'
  LEFT JOIN rates r ON v.country = r.country)"""
)

PARTNER_FACT = (
    REVENUE
    + """, partner_fact AS (
  SELECT report_month AS month_key, 'T'||track_id AS asset_id, * EXCLUDE (report_month) FROM revenue)"""
)

UNIFIED = (
    VIEW_FACT
    + ", "
    + PARTNER_FACT
    + f""", unified AS (
  SELECT cast(date_key AS varchar) AS revenue_period, '{k.DAILY}' AS period_type, '{k.YOUTUBE}' AS source_type,
         asset_id, '{k.VIDEO}' AS asset_type, '{k.VIEW_PLATFORM}' AS platform_id,
         cast(NULL AS varchar) AS distributor_id, country, views, cast(NULL AS bigint) AS streams,
         youtube_revenue_usd AS revenue_usd FROM view_fact
  UNION ALL
  SELECT month_key, '{k.MONTHLY}', '{k.DISTRIBUTOR}', asset_id, '{k.TRACK}', platform_id, distributor_id,
         country, NULL, streams, revenue_usd FROM partner_fact)"""
)

ASSET_REVENUE = (
    UNIFIED
    + """, asset_revenue AS (
  SELECT revenue_period, period_type, source_type, asset_id,
         cast(sum(revenue_usd) AS decimal(28,8)) AS revenue_usd
  FROM unified GROUP BY ALL)"""
)

#: Number i of a team of n people: any of the first n - team + i.
_PICK = """(('0x' || substr(md5('42.mapping.member|' || asset_id || '|' || i[1]), 1, 15))::bigint % (n - team + i[1]) + 1)"""


def shares(assets: str, total: str) -> str:
    """Contributor mapping of ``assets(asset_id, fewest, most)``; contributors 1..total."""
    return f"""sized AS (
  SELECT asset_id, {total} AS n,
         least(fewest + {draw("42.mapping.size", "asset_id")} % (most - fewest + 1), {total}) AS team
  FROM {assets}),
members AS (
  SELECT asset_id, team, unnest(list_reduce(
    list_prepend(cast([] AS bigint[]), list_transform(range(1, team + 1), lambda i: [i])),
    lambda chosen, i: list_append(chosen, CASE WHEN list_contains(chosen, {_PICK}) THEN n - team + i[1] ELSE {_PICK} END)
  )) AS rank
  FROM sized),
shares AS (
  SELECT asset_id, printf('CTB%03d', rank) AS contributor_id,
         {choice("42.contributor.role", k.ROLES, "rank")} AS role_in_asset, 'EQUAL' AS allocation_method,
         cast(round(1.0 / team, 4) AS decimal(6,4)) AS allocation_percent
  FROM members)"""


ROLE_SHARES = shares(
    "(SELECT 'T'||p_partkey AS asset_id, 1 AS fewest, 4 AS most FROM part UNION ALL "
    "SELECT 'V'||p_partkey, 2, 5 FROM part WHERE p_type <> 'PROMO')",
    "(SELECT count(*) FROM supplier)",
)

ALLOCATION = (
    ASSET_REVENUE
    + ", "
    + ROLE_SHARES
    + """, allocation AS (
  SELECT revenue_period, period_type, source_type, asset_id, contributor_id, role_in_asset, revenue_usd,
         allocation_percent, cast(revenue_usd AS decimal(38,8)) * allocation_percent AS allocated_revenue_usd
  FROM asset_revenue JOIN shares USING (asset_id))"""
)

LISTENS = """listens AS (
  SELECT user_id, json_extract_string(props, '$.k') AS recording_mbid, ts AS listened_at, event_id FROM events)"""

TRACKS = """tracks AS (
  SELECT cast(p_partkey AS varchar) AS track_id, 'T'||p_partkey AS asset_id, p_brand AS artist_id,
         cast(p_partkey % 7 AS varchar) AS distributor_id, p_type FROM part)"""

STREAMS = (
    LISTENS
    + ", "
    + TRACKS
    + """, streams AS (
  SELECT strftime(minute, '%Y%m') AS listen_month, recording_mbid, asset_id, artist_id, distributor_id,
         count(*) AS stream_count, count(DISTINCT user_id) AS unique_listeners
  FROM (SELECT DISTINCT user_id, recording_mbid, date_trunc('minute', listened_at) AS minute FROM listens)
  JOIN tracks ON recording_mbid = track_id AND p_type <> 'PROMO'
  GROUP BY ALL)"""
)

ARTISTS = f"""artists AS (
  SELECT row_number() OVER (ORDER BY md5('42.artists|'||artist_id), artist_id) AS rank, *,
         {choice("42.artist.distributor", [d for d, *_ in k.DISTRIBUTORS], "artist_id")} AS distributor_id,
         {choice("42.artist.label", k.LABELS, "artist_id")} AS label_name,
         {choice("42.artist.project", k.PROJECTS, "artist_id")} AS project_name,
         {status("42.artist.status", 90, "artist_id")} AS active_status,
         {day("42.artist.created", "2020-01-01", "2023-12-31", "artist_id")} AS created_date
  FROM (SELECT 'A'||c_custkey AS artist_id, c_name AS artist_name FROM customer))"""

SYNTH_TRACKS = (
    ARTISTS
    + f""", drawn AS (
  SELECT row_number() OVER (ORDER BY md5('42.tracks|'||track_id), track_id) AS rank, *,
         {draw("42.track.artist", "track_id")} % (SELECT count(*) FROM artists) + 1 AS artist_rank
  FROM (SELECT 'R'||p_partkey AS track_id, p_name AS track_title, p_brand AS release_name,
               p_type AS release_mbid FROM part)),
synth_tracks AS (
  SELECT d.rank, track_id, track_title, printf('AST_T%04d', d.rank) AS asset_id,
         printf('VN-TLB-%d-%d', {whole("42.track.isrc.year", 10, 99, "track_id")},
                {whole("42.track.isrc.number", 10000, 99999, "track_id")}) AS isrc,
         track_id AS recording_mbid, release_mbid, release_name, artist_id, distributor_id,
         {choice("42.track.label", k.LABELS, "track_id")} AS label_name,
         {choice("42.track.project", k.PROJECTS, "track_id")} AS project_name,
         {day("42.track.released", "2021-01-01", "2024-06-30", "track_id")} AS release_date,
         {status("42.track.status", 85, "track_id")} AS active_status
  FROM drawn d JOIN artists a ON d.artist_rank = a.rank)"""
)

SYNTH_VIDEOS = (
    SYNTH_TRACKS
    + f""", synth_videos AS (
  SELECT v.rank, printf('VID%04d', v.rank) AS video_id,
         track_title||' ('||{choice("42.video.label", k.CONTENT_TYPES, "v.rank")}||')' AS video_title,
         printf('AST_V%04d', v.rank) AS asset_id,
         printf('CHN%03d', {whole("42.video.channel", 1, k.CHANNEL_COUNT, "v.rank")}) AS channel_id,
         track_id, project_name,
         {choice("42.video.type", k.CONTENT_TYPES, "v.rank")} AS content_type,
         {day("42.video.uploaded", "2022-01-01", "2026-05-31", "v.rank")} AS upload_date,
         printf('ED%d', {whole("42.video.editor", 100, 999, "v.rank")}) AS editor_code
  FROM (SELECT s_suppkey + 1 AS rank, s_suppkey % (SELECT count(*) FROM part) + 1 AS track_rank FROM supplier) v
  JOIN synth_tracks t ON v.track_rank = t.rank)"""
)

_SLOTS = [code for code, _, _, weight in k.COUNTRIES for _ in range(weight)]
_PLATFORM_RATES = ", ".join(f"('{p}', cast({r} AS decimal(6,4)))" for p, r in k.STREAM_RATES.items())
_COUNTRY_CODES = ", ".join(f"('{code}')" for code, *_ in k.COUNTRIES)

SYNTH_REVENUE = (
    SYNTH_TRACKS
    + f""", on_platforms AS (
  SELECT distributor_id, artist_id, track_id, platform_id, rate FROM (
    SELECT t.*, p.*, row_number() OVER (PARTITION BY track_id ORDER BY
             md5('42.revenue.platform|'||track_id||'|'||platform_id), platform_id) AS place,
           {whole("42.revenue.platforms", 1, 3, "track_id")} AS wanted
    FROM synth_tracks t CROSS JOIN (VALUES {_PLATFORM_RATES}) p(platform_id, rate)
    WHERE active_status = 'ACTIVE')
  WHERE place <= wanted),
months AS (
  SELECT *, strftime(day, '%Y%m') AS report_month, month(day) AS m
  FROM (SELECT *, date '{k.FIRST_MONTH}' + to_months(cast(unnest(range(0, {k.MONTH_COUNT})) AS int)) AS day
        FROM on_platforms)),
draws AS (
  SELECT DISTINCT * EXCLUDE (i), {choice("42.revenue.country", _SLOTS, "track_id", "platform_id", "report_month", "i")} AS country
  FROM (SELECT *, unnest(range(1, {whole("42.revenue.countries", 2, 5, "track_id", "platform_id", "report_month")} + 1)) AS i
        FROM months)),
synth_revenue AS (
  SELECT report_month, distributor_id, platform_id, artist_id, track_id, country, streams,
         round(streams * rate, 4) AS revenue_original, 'USD' AS currency, 1.0 AS exchange_rate
  FROM (SELECT *, cast(floor({whole("42.revenue.base", 500, 50000, "track_id", "platform_id", "report_month", "country")}
                       * (1::double + 0.3::double * sin(2 * pi() * m / 12))) AS bigint) AS streams
        FROM draws))"""
)

SYNTH_VIEWS = (
    SYNTH_VIDEOS
    + f""", watched AS (
  SELECT video_id, upload_date, country FROM (
    SELECT v.*, c.*, row_number() OVER (PARTITION BY video_id ORDER BY
             md5('42.views.country|'||video_id||'|'||country), country) AS place,
           {whole("42.views.countries", 3, 8, "video_id")} AS wanted
    FROM synth_videos v CROSS JOIN (VALUES {_COUNTRY_CODES}) c(country))
  WHERE place <= wanted),
days AS (
  SELECT video_id, country, cast(d AS varchar) AS view_date
  FROM (SELECT video_id, country, upload_date,
               cast(date '{k.FIRST_MONTH}' + cast(unnest(range(0, {k.VIEW_DAYS})) AS int) AS date) AS d FROM watched)
  WHERE d >= upload_date),
synth_views AS (
  SELECT view_date, video_id, country,
         cast(least(greatest(floor((pow(1::double - {draw("42.views.amount", "video_id", "country", "view_date")}
              / 4294967296::double, -1::double / 1.5::double) - 1::double) * 1000) + 10, 0), 500000) AS bigint) AS views
  FROM days
  WHERE {draw("42.views.day", "video_id", "country", "view_date")} / 4294967296::double < 0.4::double)"""
)
