from datetime import date
from decimal import Decimal

from conftest import rows_of
from pyspark.sql import functions as F

from tallybeat.operators.conform import conform, reject_counts, rejects, unparsed_counts
from tallybeat.plans import silver
from tallybeat.sources import files


def revenue(spark, *changes):
    base = {
        "report_month": "202501",
        "distributor_id": "D",
        "platform_id": "P",
        "artist_id": "A",
        "track_id": "T",
        "country": "vn",
        "streams": "10",
        "revenue_original": "100.00",
        "currency": "usd",
        "exchange_rate": "0.04",
    }
    rows = [{**base, "country": f"c{i}", **change} for i, change in enumerate(changes)]
    schema = ", ".join(f"{name} string" for name in base)
    return spark.createDataFrame([tuple(row.values()) for row in rows], schema)


def views(spark, *rows):
    return spark.createDataFrame(rows, "view_date string, video_id string, country string, views string")


def test_padding_and_case(spark):
    raw = spark.createDataFrame([("1", "  Spotify ", "streaming")], "platform_id string, platform_name string, platform_type string")
    assert rows_of(conform(raw, silver.PLATFORMS)) == [("1", "Spotify", "STREAMING")]


def test_null_key_kept_once_without_a_rule(spark):
    raw = spark.createDataFrame([(None, "B", "x"), (None, "A", "x")], "platform_id string, platform_name string, platform_type string")
    assert rows_of(conform(raw, silver.PLATFORMS)) == [(None, "A", "X")]


def test_null_key_rejected_with_a_rule(spark):
    raw = spark.createDataFrame(
        [(None, "c", "r", "equal", "0.5"), ("a", None, "r", "equal", "0.5"), ("a", "c", " r ", "equal", "0.5")],
        "asset_id string, contributor_id string, role_in_asset string, allocation_method string, allocation_percent string",
    )
    assert rows_of(conform(raw, silver.MAPPING)) == [("a", "c", "r", "EQUAL", Decimal("0.500000"))]
    assert rows_of(rejects(raw, silver.MAPPING), "reject_reason") == [("asset_id missing",), ("contributor_id missing",)]


def test_duplicate_and_case_folded_keys(spark):
    raw = views(spark, ("2025-01-01", "v", "VN", "12"), ("2025-01-01", "v", "vn", "10"))
    assert rows_of(conform(raw, silver.VIEWS)) == [(date(2025, 1, 1), "v", "VN", 10)]


def test_measures(spark):
    raw = views(spark, *[("2025-01-01", f"v{i}", "VN", v) for i, v in enumerate(["-1", None, "0", "12.0", "x", "NaN"])])
    assert rows_of(conform(raw, silver.VIEWS), "video_id", "views") == [("v2", 0), ("v3", 12)]
    assert rows_of(reject_counts(raw, silver.VIEWS)) == [("accepted", 2), ("views missing or negative", 4)]


def test_revenue_rules(spark):
    raw = revenue(
        spark,
        {"revenue_original": None},
        {"revenue_original": "-5"},
        {"revenue_original": "0"},
        {"exchange_rate": None},
        {},
        {"track_id": None},
        {"streams": ""},
        {"revenue_original": "NaN"},
        {"revenue_original": "1e-05", "exchange_rate": "1.0"},
    )
    found = rows_of(conform(raw, silver.PARTNER_REVENUE), "country", "revenue_usd")
    assert found == [("C2", 0), ("C3", None), ("C4", Decimal("4.00")), ("C8", Decimal("0.00001"))]


def test_bad_date_keeps_the_row_and_is_counted(spark):
    raw = views(spark, ("2024-13-01", "v", "VN", "1"), ("2024-12-01", "w", "VN", "1"), (None, "x", "VN", "1"))
    assert rows_of(conform(raw, silver.VIEWS), "video_id", "view_date") == [
        ("v", None),
        ("w", date(2024, 12, 1)),
        ("x", None),
    ]
    assert rows_of(unparsed_counts(raw, silver.VIEWS)) == [("view_date", 1), ("views", 0)]


def test_only_whole_dates_count(spark):
    texts = ["2024-02-29", "2023-02-29", "2024", "2024-1-1", "2024-01-01T00:00", " 2024-01-01", "2024-01-01\n", ""]
    raw = views(spark, *[(text, f"v{i}", "VN", "1") for i, text in enumerate(texts)])
    found = conform(raw, silver.VIEWS).filter("view_date is not null")
    assert rows_of(found, "video_id", "view_date") == [("v0", date(2024, 2, 29))]


def test_two_rate_periods_keep_the_earlier(spark):
    raw = spark.createDataFrame(
        [("vn", "V", "0.002", "2025-01-01", "2025-12-31"), ("VN", "V", "0.001", "2024-01-01", "2024-12-31")],
        "country string, country_name string, rate_per_view_usd string, effective_from string, effective_to string",
    )
    assert rows_of(conform(raw, silver.RATES), "country", "rate_per_view_usd") == [("VN", Decimal("0.00100000"))]


def test_csv_namibia_and_empty_cells(spark, tmp_path):
    (tmp_path / "v.csv").write_text(
        "view_date,video_id,country,views\n2025-01-01,v1,NA,5\n2025-01-01,,VN,5\n2025-01-01,v3,VN,\n"
    )
    raw = files.read_csv(spark, str(tmp_path))
    assert rows_of(conform(raw, silver.VIEWS)) == [(date(2025, 1, 1), "v1", "NA", 5)]


def test_accepted_rejected_and_duplicates_add_up(spark):
    raw = views(spark, *[(f"2025-01-{1 + i % 3:02d}", f"v{i % 5}", "VN", str(i % 7 - 1)) for i in range(200)])
    refused = rejects(raw, silver.VIEWS).count()
    accepted = {row["reject_reason"]: row["row_count"] for row in reject_counts(raw, silver.VIEWS).collect()}
    assert refused + accepted["accepted"] == 200
    assert conform(raw, silver.VIEWS).count() == 15


def test_same_result_in_any_order_and_partitioning(spark):
    raw = revenue(spark, *[{"country": f"c{i % 9}", "streams": str(i), "artist_id": f"a{i % 4}"} for i in range(300)])
    expected = rows_of(conform(raw, silver.PARTNER_REVENUE))
    for parts in (1, 7):
        mixed = raw.repartition(parts, F.xxhash64("streams"))
        assert rows_of(conform(mixed, silver.PARTNER_REVENUE)) == expected
