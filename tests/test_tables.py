from conftest import rows_of
from pyspark.sql import functions as F

from tallybeat.session import run_dir, shared_dir
from tallybeat.sources import tables


def test_write_replace_and_count(spark, namespace):
    name = f"{namespace}.t"
    assert tables.write_table(spark.range(10), name) == 10
    assert tables.write_table(spark.range(3).select(F.lit("x").alias("k"), "id"), name, "k") == 3
    assert rows_of(spark.table(name).groupBy("k").count()) == [("x", 3)]
    assert tables.write_table(spark.range(0), name) == 0


def test_partition_with_a_third_of_the_rows_is_complete(spark, namespace):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 11)).alias("m"))
    assert tables.write_table(rows, f"{namespace}.p", "m") == 9000
    assert rows_of(spark.table(f"{namespace}.p")) == rows_of(rows)
    assert spark.table(f"{namespace}.p").filter("m = 'hot'").count() == 3000


def test_staged_result_lives_in_the_shared_folder(spark):
    kept = tables.staged(spark.range(5), "x")
    assert rows_of(kept) == [(i,) for i in range(5)]
    assert all(shared_dir(spark) in name for name in kept.inputFiles())
    assert run_dir(spark, "a") != run_dir(spark, "a")


def test_cached(spark):
    with tables.cached(spark.range(4)) as (rows, count):
        assert count == 4 and rows.is_cached
    assert not rows.is_cached


def test_list_drop_register_and_log(spark, namespace):
    for name in ("b_fact", "a_dim", "c_fact"):
        tables.write_table(spark.range(2), f"{namespace}.{name}")
    assert [row.table_name for row in tables.list_tables(spark, namespace).collect()] == ["a_dim", "b_fact", "c_fact"]
    assert tables.list_tables(spark, namespace, prefix="a").count() == 1
    assert tables.drop_tables(spark, namespace, "fact") == [f"{namespace}.b_fact", f"{namespace}.c_fact"]
    assert tables.drop_table(spark, f"{namespace}.gone")
    path = run_dir(spark, "data")
    spark.range(6).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(path)
    tables.register_location(spark, f"{namespace}.found", path)
    assert spark.table(f"{namespace}.found").count() == 6
    plain = run_dir(spark, "data")
    spark.range(6).write.parquet(plain)
    tables.register_location(spark, f"{namespace}.plain", plain)
    assert spark.table(f"{namespace}.plain").count() == 6
    for i in range(12):
        tables.log_write(spark, f"{namespace}.log", f"t{i:02d}", i, "m")
    assert [row.row_count for row in tables.latest_writes(spark, f"{namespace}.log").collect()] == list(range(11, 1, -1))
    assert (namespace,) in rows_of(tables.list_namespaces(spark))


def test_staging_removes_what_was_staged(spark):
    """At the end of its scope, inner scopes first, also after an error; outside at the end of the application."""
    before = tables.staged_folders(spark)
    with tables.staging(spark):
        outer = tables.staged(spark.range(5), "outer")
        with tables.staging(spark):
            inner = tables.staged(outer.select(F.col("id") * 2), "inner")
            assert inner.count() == 5 and len(tables.staged_folders(spark)) == len(before) + 2
        assert outer.count() == 5 and len(tables.staged_folders(spark)) == len(before) + 1
    assert tables.staged_folders(spark) == before
    try:
        with tables.staging(spark):
            tables.staged(spark.range(3), "first")
            tables.staged(spark.range(3).select(F.raise_error(F.lit("no"))), "broken")
    except Exception as error:
        assert "no" in str(error)
    assert tables.staged_folders(spark) == before
    assert tables.staged(spark.range(5), "left").count() == 5
    name = next(n for n in tables.staged_folders(spark) if n.startswith("left-") and n not in before)
    place, files = tables._place(spark, f"{shared_dir(spark)}/tallybeat/staged/{name}")
    assert files.cancelDeleteOnExit(place) and files.deleteOnExit(place)
