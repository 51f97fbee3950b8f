"""Landed rows and the record that publishes them.

A pass of the ingest lands the rows of many source files in a few compact files, in a folder
of its own: ``ingested_date=.../pass=...``. Only when all of them are there does the record under
``_manifest`` name the folder, by one committed file. Readers go by the record, so
what a run left behind that died is never seen. Rows carry ``source_file`` and ``source_row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ENTRY = (
    "ingested_date string, file_no bigint, file_name string, bytes bigint, landed_rows bigint, status string, "
    "landed_in string"
)
#: Where a row comes from: the file's name and the row's place in it.
ORIGIN = StructType().add("source_file", "string").add("source_row", "long")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything a pattern stands for, is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def pass_folder(ingested_date: str, name: str) -> str:
    return f"ingested_date={ingested_date}/pass={name}"


def has_record(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root}/_manifest")


def entries(spark: SparkSession, root: str, ingested_date: str | None = None) -> DataFrame:
    """One row per file tried for a date: LOADED, EMPTY or FAILED; empty before the first run."""
    if not has_record(spark, root):
        return spark.createDataFrame([], ENTRY)
    tried = spark.read.schema(ENTRY).parquet(f"{root}/_manifest")
    if ingested_date is not None:
        tried = tried.filter(F.col("ingested_date") == ingested_date)
    best = F.max(F.struct((F.col("status") != "FAILED").alias("landed"), "bytes", "landed_rows", "status", "landed_in"))
    return tried.groupBy("ingested_date", "file_no", "file_name").agg(best.alias("best")).select(
        "ingested_date", "file_no", "file_name", "best.bytes", "best.landed_rows", "best.status", "best.landed_in"
    )


def read_landed(spark: SparkSession, root: str, recorded: DataFrame, schema: StructType) -> DataFrame:
    """Rows of the passes that the given entries of the record name, with ingested_date."""
    folders = recorded.filter(F.col("landed_in").isNotNull()).select("ingested_date", "landed_in").distinct()
    paths = [f"{root}/{pass_folder(*row)}" for row in folders.collect()]  # a name per pass of many files
    given = [f for f in schema.fields if f.name not in ("ingested_date", "pass")]
    dated = StructType(given).add("ingested_date", "string")
    if not paths:
        return spark.createDataFrame([], dated)
    passes = StructType(dated.fields[:]).add("pass", "string")
    return spark.read.schema(passes).option("basePath", root).parquet(*paths).drop("pass")
