import hashlib
import random
from collections import defaultdict

import pytest
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from tallybeat.operators import quality
from tallybeat.operators.dedupe import first_seen, flatten_lists, keep_first, one_per_minute
from tallybeat.operators.joins import fan_out_grid, fan_out_join, in_force, keep_members, keep_strangers, small_side, valid_at
from tallybeat.operators.ranking import hash_rank, seeded_sample, top


def skewed(n, seed=1):
    """Keys of which one holds a third of the rows."""
    pick = random.Random(seed)
    return [("hot" if pick.random() < 0.34 else f"k{pick.randrange(60)}", pick.randrange(1000), i) for i in range(n)]


def test_keep_first_against_brute_force_with_a_hot_and_a_null_key(spark):
    data = [(key if key != "k7" else None, value, i) for key, value, i in skewed(3000)]
    best = {}
    for key, value, i in data:
        best[key] = min(best.get(key, (value, i)), (value, i))
    frame = spark.createDataFrame(data, "key string, value int, id int")
    for parts in (1, 6):
        found = keep_first(frame.repartition(parts), ["key"], ["value"])
        assert rows_of(found) == sorted(((k, *v) for k, v in best.items()), key=repr)


def test_keep_first_shrinks_a_hot_key_before_the_shuffle(spark):
    plan = plan_of(keep_first(spark.createDataFrame(skewed(10), "key string, value int, id int"), ["key"]))
    assert "partial_min" in plan and "Window" not in plan


def test_keep_first_with_keys_only_and_single_payload(spark):
    frame = spark.createDataFrame([("a", 2), ("a", 1), ("b", None), ("b", 5)], "k string, v int")
    assert rows_of(keep_first(frame.select("k"), ["k"])) == [("a",), ("b",)]
    assert rows_of(keep_first(frame, ["k"])) == [("a", 1), ("b", None)]
    assert rows_of(keep_first(frame.filter("v is not null"), ["k"], never_null=["v"])) == [("a", 1), ("b", 5)]


def test_one_per_minute(spark):
    at = ["2025-01-01 10:00:01", "2025-01-01 10:00:59", "2025-01-01 10:01:00"]
    frame = spark.createDataFrame([(1, "r", t) for t in at], "user_id int, recording_mbid string, t string")
    found = one_per_minute(frame.withColumn("listened_at", F.col("t").cast("timestamp")))
    assert rows_of(found.select(F.date_format("listened_at", "HH:mm:ss"))) == [("10:00:01",), ("10:01:00",)]


def test_first_seen_and_flatten(spark):
    frame = spark.createDataFrame(
        [(1, ["b", "a", "b", ""], "n1"), (0, ["a", None], "n0"), (2, [], "n2"), (3, None, "n3")],
        "row_no int, ids array<string>, name string",
    )
    flat = flatten_lists(frame, "ids", "id", ["row_no", "name"])
    assert rows_of(flat, "row_no", "id") == [(0, "a"), (1, "a"), (1, "b")]
    assert rows_of(first_seen(flat, "id", ["row_no"], ["name"])) == [("a", "n0"), ("b", "n1")]


@pytest.mark.parametrize("tile", [1, 7, 100, 2000, 1 << 22])
def test_fan_out_join_against_brute_force(spark, tile):
    """Keys long on the left, on the right, on both sides, on one only; null keys; repeated rows."""
    pick = random.Random(3)
    left = [(f"a{i % 20}" if i % 3 else "hot", i) for i in range(120)] + [("wide", 1), ("wide", 1), (None, 5)]
    left += [("tall", i) for i in range(150)] + [("alone", i) for i in range(50)]
    right = [("hot" if pick.random() < 0.4 else f"a{pick.randrange(25)}", f"c{i}") for i in range(400)]
    right += [(None, "none"), ("tall", "x"), ("tall", "x"), ("tall", "y")] + [("wide", f"w{i}") for i in range(300)]
    by_key = defaultdict(list)
    for key, c in right:
        by_key[key].append(c)
    expected = sorted(((k, v, c) for k, v in left if k for c in by_key[k]), key=repr)
    a = spark.createDataFrame(left, "asset string, v int")
    b = spark.createDataFrame(right, "asset string, c string")
    assert rows_of(fan_out_join(a, b, "asset", ["v"], ["c"], tile)) == expected


def test_fan_out_grid_cuts_the_longer_side(spark):
    a = spark.createDataFrame([("tall", i) for i in range(1000)] + [("wide", 1)] + [("big", i) for i in range(400)], "k string, v int")
    b = spark.createDataFrame([("tall", 1)] * 3 + [("wide", i) for i in range(900)] + [("big", i) for i in range(300)], "k string, c int")
    grid = {r.k: (r._row_parts, r._detail_parts) for r in fan_out_grid(a, b, "k", 100).collect()}
    assert grid == {"tall": (30, 1), "wide": (1, 9), "big": (40, 30)}
    assert fan_out_grid(a, b, "k", 10**6).isEmpty()
    bounded = {r.k: (r._row_parts, r._detail_parts) for r in fan_out_grid(a, b, "k", 100, most_rows=5).collect()}
    assert bounded == {"wide": (1, 45), "big": (1, 15)}
    joined = fan_out_join(a, b, "k", ["v"], ["c"], 100, most_rows=1000)
    assert joined.count() == 3000 + 900 + 120_000


@pytest.mark.parametrize("long", ["rows", "details"])
def test_fan_out_join_spreads_a_hot_key(spark, long):
    """The output of one key comes from many tasks, whichever side is long."""
    few = spark.createDataFrame([("hot", i) for i in range(10)], "asset string, v int")
    many = spark.range(4000).select(F.lit("hot").alias("asset"), F.col("id").alias("c"))
    sides = (many, few, "asset", ["c"], ["v"]) if long == "rows" else (few, many, "asset", ["v"], ["c"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = fan_out_join(*sides, tile=1000)
        per_task = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per_task) == 40_000 and len(per_task) == 4 and max(per_task) < 20_000


def test_fan_out_join_repeats_the_shorter_side_only(spark):
    """Plans: nothing is expanded without a long key; with one, the longer side is not."""
    rows = spark.range(2000).select(F.lit("hot").alias("asset"), F.col("id").alias("v"))
    few = spark.createDataFrame([("hot", i) for i in range(10)], "asset string, c int")
    assert "Generate" not in plan_of(fan_out_join(rows, few, "asset", ["v"], ["c"]))
    plan = plan_of(fan_out_join(rows, few, "asset", ["v"], ["c"], tile=1000))
    assert plan.count("Generate explode") == 1 or plan.count(") Generate") == 1
    generate = plan[plan.rindex(") Generate") :].split("Arguments:")[1].split("\n")[0]
    assert "_row_parts" in generate and "_detail_parts" not in generate


def test_semi_and_anti(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("x",)], "k string")
    assert rows_of(keep_members(a, b, "k")) == [("x",)]
    assert rows_of(keep_strangers(a, b, "k")) == [("y",), (None,)]


@pytest.mark.parametrize("digits", [1, 4])
def test_hash_rank_against_brute_force(spark, digits):
    ids = [f"id{i}" for i in range(500)]
    order = sorted(ids, key=lambda i: (hashlib.md5(f"s|{i}".encode()).hexdigest(), i))
    pool = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    found = {row["id"]: row["rank"] for row in hash_rank(pool, "id", "s", digits=digits).collect()}
    assert found == {i: n for n, i in enumerate(order, 1)}
    few = hash_rank(pool, "id", "s", first=37, digits=digits)
    assert rows_of(few, "rank", "id") == sorted(((n, i) for n, i in enumerate(order[:37], 1)), key=repr)
    assert rows_of(seeded_sample(pool, "id", 9999, "s")) == sorted((i,) for i in ids)


def test_top_breaks_ties_by_id(spark):
    frame = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "id string, v int")
    assert [row.id for row in top(frame, 2, F.desc("v"), F.asc("id")).collect()] == ["a", "b"]
    assert "TakeOrderedAndProject" in plan_of(top(frame, 2, F.desc("v")))


def test_counts_profile_schema_reconcile(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    assert rows_of(quality.count_tables({"a": a, "b": a.limit(0)})) == [("TOTAL", 2), ("a", 2), ("b", 0)]
    assert rows_of(quality.profile(a)) == [(1, "k", "string", 1), (2, "v", "int", 2)]
    assert rows_of(quality.schema_report(a)) == [(1, "k", "string"), (2, "v", "int")]
    wanted = spark.createDataFrame([("1",), ("2",)], "f string")
    found = spark.createDataFrame([("2",), ("3",)], "f string")
    assert rows_of(quality.reconcile(wanted, found, "f")) == [("1", "MISSING"), ("2", "OK"), ("3", "EXTRA")]
    assert rows_of(quality.reconcile_summary(wanted, found, "f")) == [(2, 2, "MISMATCH")]
    assert rows_of(quality.reconcile_summary(wanted, wanted, "f")) == [(2, 2, "OK")]


def test_reconcile_content(spark):
    """Order does not matter; a changed value, a row twice for another, a null key, a file on one side."""
    schema = "f string, a int, b string"
    left = [("same", i, "x") for i in range(5)] + [("value", 1, "x"), ("twice", 1, "x"), ("twice", 1, "x"), ("twice", 2, "y")]
    left += [("late", 1, "x"), (None, 1, None), ("swap", 1, "2"), ("count", 1, "x")]
    right = [("same", i, "x") for i in reversed(range(5))] + [("value", 1, "z"), ("twice", 2, "y"), ("twice", 2, "y"), ("twice", 1, "x")]
    right += [("stray", 1, "x"), (None, 1, None), ("swap", 2, "1"), ("count", 1, "x"), ("count", 1, "x")]
    found = quality.reconcile_content(
        spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema), "f", ["a", "b"]
    )
    assert rows_of(found, "f", "expected_rows", "found_rows", "status") == [
        ("count", 1, 2, "DIFFERENT"), ("late", 1, 0, "MISSING"), ("same", 5, 5, "OK"), ("stray", 0, 1, "EXTRA"),
        ("swap", 1, 1, "DIFFERENT"), ("twice", 3, 3, "DIFFERENT"), ("value", 1, 1, "DIFFERENT"), (None, 1, 1, "OK"),
    ]
    assert quality.reconcile_content(spark.createDataFrame([], schema), spark.createDataFrame([], schema), "f", ["a"]).count() == 0


PERIODS = [
    ("gap", "2024-01-01", "2024-03-31", 1), ("gap", "2024-06-01", None, 2),
    ("over", "2024-01-01", "2024-12-31", 3), ("over", "2024-05-01", "2024-06-15", 4),
    ("open", None, "2024-02-10", 5), ("open", "2024-02-05", "2024-02-20", 6),
    ("tie", "2024-01-01", "2024-01-31", 7), ("tie", "2024-01-01", None, 8), ("tie", "2024-01-01", None, 9),
    ("back", "2024-05-01", "2024-04-01", 10), ("days", "2024-02-29", "2024-02-29", 11),
]


def plain_rate(key, day):
    """Of the periods begun by the day the last one, if it has not ended."""
    begun = [p for p in PERIODS if p[0] == key and (not p[1] or not p[2] or p[1] <= p[2]) and (p[1] or "") <= day]
    if not begun:
        return None
    last = max(begun, key=lambda p: (p[1] or "", p[2] is None, p[2] or "", p[3]))
    return last[3] if last[2] is None or day <= last[2] else None


@pytest.mark.parametrize("most", [0, 50_000])
def test_valid_at_against_brute_force(spark, most):
    """Gaps, overlaps, open ends, equal starts, no period, null day: by broadcast and by buckets."""
    import datetime

    days = [str(datetime.date(2023, 12, 1) + datetime.timedelta(i)) for i in range(0, 500, 3)] + ["2024-02-29", "2024-02-05"]
    rows = [(key, day) for key in {p[0] for p in PERIODS} | {"none"} for day in days]
    odd = [("gap", None), (None, "2024-01-01")]
    periods = spark.createDataFrame(PERIODS, "k string, a string, b string, rate int")
    periods = periods.withColumns({"a": F.col("a").cast("date"), "b": F.col("b").cast("date")})
    frame = spark.createDataFrame(rows + rows + odd, "k string, day string").withColumn("day", F.col("day").cast("date"))
    found = valid_at(frame, periods, "k", "day", "a", "b", most).select("k", F.col("day").cast("string"), "rate")
    assert rows_of(found) == sorted([(k, d, plain_rate(k, d)) for k, d in rows + rows] + [(*o, None) for o in odd], key=repr)
    assert valid_at(frame.limit(0), periods, "k", "day", "a", "b", most).count() == 0
    assert valid_at(frame, periods.limit(0), "k", "day", "a", "b", most).filter("rate is null").count() == len(rows) * 2 + 2
    plan = plan_of(valid_at(frame, periods, "k", "day", "a", "b", most))
    assert ("_day_bucket" in plan) == (most == 0) and "NestedLoop" not in plan


def test_in_force_and_small_side(spark):
    periods = spark.createDataFrame(PERIODS, "k string, a string, b string, rate int")
    periods = periods.withColumns({"a": F.col("a").cast("date"), "b": F.col("b").cast("date")})
    cut = in_force(periods, "k", "a", "b").filter("k in ('over', 'open', 'tie')")
    assert rows_of(cut.select("k", F.col("a").cast("string"), F.col("b").cast("string"), "rate")) == [
        ("open", "2024-02-05", "2024-02-20", 6), ("open", None, "2024-02-04", 5), ("over", "2024-01-01", "2024-04-30", 3),
        ("over", "2024-05-01", "2024-06-15", 4), ("tie", "2024-01-01", None, 9),
    ]
    assert "broadcast" in small_side(spark.range(5), 5)._jdf.queryExecution().toString()
    assert "broadcast" not in small_side(spark.range(6), 5)._jdf.queryExecution().toString()
