"""Catalog tables: write, stage, list, drop, register, and a log of the writes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallybeat.session import run_dir, shared_dir

LOG = "table_name string, row_count bigint, message string"


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def write_table(rows: DataFrame, name: str, partition_by: str | None = None) -> int:
    """Create or replace a table and return its number of rows.

    A partitioned table is rebalanced by its partition column first: small partitions are
    written by one task each, not by all, and adaptive execution cuts a partition that
    holds much of the table into several tasks. Rows are counted by the writing tasks, so
    nothing is scanned again.
    """
    if partition_by:
        rows = rows.hint("rebalance", F.col(partition_by))
    counter = Observation()
    writer = rows.observe(counter, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)
    return counter.get["row_count"]


#: Folders staged within the open scopes of this thread of work, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging scopes", default=())


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Write to a new place in the shared folder and read back.

    Cuts the lineage: whoever uses the result, or loses an executor, reads files. The files live
    until the scope ends in which they were made (``staging``), outside of any scope until the
    application ends.
    """
    spark = rows.sparkSession
    path = run_dir(spark, f"staged/{name}")
    scopes = _scopes.get()
    if scopes:
        scopes[-1].append(path)  # before the write, which may leave files even if it fails
    rows.write.parquet(path)
    if not scopes:
        place, files = _place(spark, path)
        files.deleteOnExit(place)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A scope at whose end all that was staged within is removed.

    Whatever reads staged files must be written, or collected, before. Also after an error nothing
    stays, and a retry stages anew under other names, so it cannot meet half-written files.
    """
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            place, files = _place(spark, path)
            files.delete(place, True)


def staged_folders(spark: SparkSession) -> list[str]:
    """Names of the staged folders that are there."""
    place, files = _place(spark, f"{shared_dir(spark)}/tallybeat/staged/*")
    return sorted(found.getPath().getName() for found in files.globStatus(place) or [])


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def cached(rows: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """Keep rows for several uses within the block; yields them and their number."""
    kept = rows.persist()
    try:
        yield kept, kept.count()
    finally:
        kept.unpersist()


def list_tables(
    spark: SparkSession, namespace: str, contains: str | None = None, prefix: str | None = None
) -> DataFrame:
    """Names of the tables of a namespace, sorted, optionally filtered by name."""
    tables = (
        spark.sql(f"SHOW TABLES IN {namespace}")
        .filter(~F.col("isTemporary"))
        .select(F.lit(namespace).alias("namespace"), F.col("tableName").alias("table_name"))
    )
    if contains:
        tables = tables.filter(F.col("table_name").contains(contains))
    if prefix:
        tables = tables.filter(F.col("table_name").startswith(prefix))
    return tables.orderBy("table_name")


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop a table if there is one; a reference nothing stands behind is no error."""
    try:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    except AnalysisException:
        return False
    return True


def drop_tables(spark: SparkSession, namespace: str, contains: str | None = None) -> list[str]:
    """Drop the listed tables of a namespace; returns the names that are gone."""
    names = [
        f"{namespace}.{row.table_name}"
        for row in list_tables(spark, namespace, contains).collect()
    ]
    return [name for name in names if drop_table(spark, name)]


def register_location(spark: SparkSession, name: str, path: str, kind: str = "parquet") -> None:
    """Make existing files a table without moving them; finds partition folders."""
    spark.catalog.createTable(name, path=path, source=kind)
    if spark.sql(f"DESCRIBE TABLE {name}").filter("col_name = '# Partition Information'").count():
        spark.catalog.recoverPartitions(name)


def log_write(spark: SparkSession, log: str, table: str, row_count: int, message: str) -> None:
    """Append one entry to the table of writes."""
    entry = spark.createDataFrame([(table, row_count, message)], LOG)
    entry.withColumn("written_at", F.current_timestamp()).write.mode("append").saveAsTable(log)


def latest_writes(spark: SparkSession, log: str, n: int = 10) -> DataFrame:
    """The last ``n`` entries, newest first."""
    newest: list[Column] = [F.desc("written_at"), F.asc("table_name")]
    return spark.table(log).orderBy(*newest).limit(n)
