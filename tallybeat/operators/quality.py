"""Counts, schema, profile and reconciliation reports, all as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybeat.sources.files import unreadable

COUNTS = "table_name string, row_count bigint, status string"


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and the grand total, in one lazy query."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in tables.items()
    ]
    return (
        reduce(DataFrame.unionByName, counts)
        .rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "row_count")
    )


def count_tables_tolerant(spark: SparkSession, names: list[str]) -> DataFrame:
    """Rows per named table; a missing or unreadable one is reported and the rest counted.

    Names are resolved first, which reads no rows; then one job counts all tables, by their rows' names
    alone: no column is read. Only if a file cannot be read the tables are counted in halves, down
    to the one that holds it. Any other error is raised.
    """
    tables = {}
    for name in names:
        try:
            if spark.catalog.tableExists(name):
                tables[name] = spark.table(name)
        except AnalysisException:  # a name or a definition that cannot be resolved
            continue
    counts = _counted(tables)
    report = [(name, counts.get(name), "OK" if name in counts else "ERROR") for name in names]
    return spark.createDataFrame([*report, ("TOTAL", sum(counts.values()), "OK")], COUNTS)


def _counted(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows of the tables that can be read; one job unless one cannot."""
    if not tables:
        return {}
    try:
        marks = [rows.select(F.lit(name).alias("table_name")) for name, rows in tables.items()]
        found = reduce(DataFrame.unionByName, marks).groupBy("table_name").count().collect()
        return dict.fromkeys(tables, 0) | {row.table_name: row["count"] for row in found}
    except (PySparkException, Py4JJavaError) as error:
        if isinstance(error, AnalysisException):
            pass  # a table went between its name and its count
        elif not unreadable(error):
            raise
    if len(tables) == 1:
        return {}
    names = list(tables)
    half = len(names) // 2
    return {n: c for part in (names[:half], names[half:]) for n, c in _counted({n: tables[n] for n in part}).items()}


def schema_report(rows: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    return rows.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema, 1)],
        "position int, column_name string, column_type string",
    )


def profile(rows: DataFrame) -> DataFrame:
    """Type and number of given values of every column; one pass over the table."""
    counted = rows.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in rows.columns])
    values = counted.unpivot([], rows.columns, "column_name", "non_null")
    return values.join(F.broadcast(schema_report(rows)), "column_name").select(
        "position", "column_name", "column_type", "non_null"
    )


def reconcile(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Every key of either side: OK, MISSING (not found) or EXTRA (not expected)."""
    left = expected.select(key).distinct().withColumn("_expected", F.lit(True))
    right = found.select(key).distinct().withColumn("_found", F.lit(True))
    status = (
        F.when(F.col("_found").isNull(), F.lit("MISSING"))
        .when(F.col("_expected").isNull(), F.lit("EXTRA"))
        .otherwise(F.lit("OK"))
    )
    return left.join(right, key, "full_outer").select(key, status.alias("status"))


def reconcile_summary(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row: numbers on both sides and OK only when every key matches."""
    return reconcile(expected, found, key).agg(
        F.count_if(F.col("status") != "EXTRA").alias("expected"),
        F.count_if(F.col("status") != "MISSING").alias("found"),
        F.when(F.count_if(F.col("status") != "OK") == 0, "OK").otherwise("MISMATCH").alias("status"),
    )


def fingerprints(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per key the number of rows, and the exclusive or and the sum of 64-bit hashes of the rows.

    Free of order and partitioning, with a partial step before the shuffle. The sum sees
    a row that comes twice, which the exclusive or takes out again.
    """
    hashed = rows.select(key, F.xxhash64(*columns).alias("_hash"))
    return hashed.groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.bit_xor("_hash").alias("hash_xor"),
        F.sum(F.col("_hash").cast("decimal(20,0)")).alias("hash_sum"),
    )


def reconcile_content(expected: DataFrame, found: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every key of either side with its rows: OK, MISSING, EXTRA, or DIFFERENT where the rows are not the same.

    Both sides are read once; only fingerprints meet. Null keys match each other.
    """
    marks = ("row_count", "hash_xor", "hash_sum")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return fingerprints(rows, key, columns).select(
            F.col(key).alias(f"_{name}_key"), F.struct(*marks).alias(f"_{name}")
        )

    pairs = side(expected, "left").join(
        side(found, "right"), F.col("_left_key").eqNullSafe(F.col("_right_key")), "full_outer"
    )
    status = (
        F.when(F.col("_right").isNull(), "MISSING")
        .when(F.col("_left").isNull(), "EXTRA")
        .when(F.col("_left") == F.col("_right"), "OK")
        .otherwise("DIFFERENT")
    )
    rows_of = lambda name: F.coalesce(F.col(f"_{name}.row_count"), F.lit(0)).cast("bigint")
    return pairs.select(
        F.coalesce("_left_key", "_right_key").alias(key),
        rows_of("left").alias("expected_rows"),
        rows_of("right").alias("found_rows"),
        status.alias("status"),
    )


def prefix_usage(files: DataFrame) -> DataFrame:
    """Files and bytes per prefix and in total."""
    return (
        files.rollup("prefix")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .select(F.coalesce("prefix", F.lit("TOTAL")).alias("prefix"), "files", "bytes")
    )
