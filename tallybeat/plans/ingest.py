"""Incremental landing of Parquet files, file by file and safe to repeat.

Rows land in passes of many files, by jobs that read strictly: a job either lands all rows of its
files or none, so no file is ever there in part. A pass is published by its entries in the record
(``sources.landings``), after its rows have landed. A run takes the files that the record does
not call LOADED or EMPTY: new ones, those that could not be read, and those that a run that died
had not recorded yet; what that run left behind is not read. One run at a time may land
files of a date.
"""

from __future__ import annotations

import uuid
from itertools import batched

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybeat.operators.joins import keep_strangers
from tallybeat.sources.files import list_files, parquet_schema, unreadable
from tallybeat.sources.landings import entries, pass_folder, path_exists

PATTERN = "*.parquet"


def require_path(spark: SparkSession, path: str) -> None:
    """Fail early, and clearly, when an input location is not there."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)


def new_files(spark: SparkSession, source: str, target: str, ingested_date: str) -> DataFrame:
    """Source files that are not recorded as landed for the date; nothing is opened."""
    finished = entries(spark, target, ingested_date).filter(F.col("status") != "FAILED")
    return keep_strangers(list_files(spark, source, PATTERN), finished, "file_name")


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    ingested_date: str,
    schema: StructType | None = None,
    files_per_pass: int = 1000,
) -> DataFrame:
    """Land what is new, in the numeric order of the file names, and return the manifest.

    A pass hands the names of at most ``files_per_pass`` files to the reader, so the driver
    holds no list that grows with the source. An unreadable file does not stop the others.
    """
    require_path(spark, source)
    schema = schema or parquet_schema(spark, source)
    fresh = new_files(spark, source, target, ingested_date)
    numbered = fresh.select("path", "file_no", "file_name", "length").orderBy(
        F.coalesce("file_no", F.lit(-1)), "file_name"
    )
    # Sorted once; the driver holds one part of the listing at a time.
    for batch in batched(numbered.toLocalIterator(), files_per_pass):
        landed, broken = _land(spark, [row.path for row in batch], target, ingested_date, schema)
        _record(spark, [row for row in batch if row.path in broken], None, None, target, ingested_date)
        for name, paths in landed.items():
            own = set(paths)
            counts = (
                spark.read.schema("source_file string")
                .parquet(f"{target}/{pass_folder(ingested_date, name)}")
                .groupBy(F.col("source_file").alias("file_name"))
                .agg(F.count("*").alias("row_count"))
            )
            _record(spark, [row for row in batch if row.path in own], counts, name, target, ingested_date)
    return manifest(spark, target, ingested_date)


def manifest(spark: SparkSession, target: str, ingested_date: str) -> DataFrame:
    """One row per file tried for a date: LOADED, EMPTY or FAILED; empty before the first run."""
    return entries(spark, target, ingested_date)


def outcome(entries: DataFrame) -> DataFrame:
    """Files, rows and bytes per status of a manifest."""
    return entries.groupBy("status").agg(
        F.count("*").alias("files"),
        F.sum("landed_rows").alias("landed_rows"),
        F.sum("bytes").alias("bytes"),
    )


def _land(
    spark: SparkSession, paths: list[str], target: str, ingested_date: str, schema: StructType
) -> tuple[dict[str, list[str]], set[str]]:
    """Land files in one job; the passes with their paths, and the paths that cannot be read.

    Rows lie as the tasks read them, many small files to a task, so a date has files by its bytes, not
    by its sources. A job that meets an unreadable file publishes nothing. Its files are then tried
    in halves, down to the single file, so a broken file costs a few jobs and the others land.
    """
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", False).parquet(*paths)
    name = uuid.uuid4().hex
    try:
        rows.select(
            *schema.fieldNames(),
            F.col("_metadata.file_name").alias("source_file"),
            F.col("_metadata.row_index").alias("source_row"),
        ).write.parquet(f"{target}/{pass_folder(ingested_date, name)}")
    except (PySparkException, Py4JJavaError) as error:
        if not unreadable(error):
            raise
        if len(paths) == 1:
            return {}, set(paths)
        half = len(paths) // 2
        landed, broken = _land(spark, paths[:half], target, ingested_date, schema)
        others, also_broken = _land(spark, paths[half:], target, ingested_date, schema)
        return landed | others, broken | also_broken
    return {name: paths}, set()


def _record(
    spark: SparkSession,
    files: list,
    counts: DataFrame | None,
    landed_in: str | None,
    target: str,
    ingested_date: str,
) -> None:
    """Append what became of the files of a pass; without counts they have failed."""
    if not files:
        return
    tried = spark.createDataFrame(
        [(ingested_date, row.file_no, row.file_name, row.length) for row in files],
        "ingested_date string, file_no bigint, file_name string, bytes bigint",
    )
    place = F.lit(landed_in).cast("string").alias("landed_in")
    if counts is None:
        found = tried.select("*", F.lit(0).cast("bigint").alias("landed_rows"), F.lit("FAILED").alias("status"), place)
    else:
        landed = F.coalesce("row_count", F.lit(0)).cast("bigint")
        status = F.when(landed > 0, "LOADED").otherwise("EMPTY").alias("status")
        found = tried.join(counts, "file_name", "left").select(*tried.columns, landed.alias("landed_rows"), status, place)
    found.coalesce(1).write.mode("append").parquet(f"{target}/_manifest")  # one pass, bounded
