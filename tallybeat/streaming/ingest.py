"""Landing of Parquet files as a file stream, for sources that never stop growing.

The checkpoint remembers the files by name and the sink commits each micro-batch once, so
a restart after any failure neither repeats nor loses rows. A file that cannot be read stops
the stream before its batch is committed; after the file is repaired, a restart reads the
batch again. The batch form in ``plans.ingest`` lands the others meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def land_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    ingested_date: str,
    schema: StructType | str,
    files_per_batch: int = 1000,
) -> None:
    """Land every file not seen before, then stop. ``landed_rows`` tells what has arrived."""
    arriving = (
        spark.readStream.schema(schema)
        .option("fileNameOnly", True)
        .option("ignoreCorruptFiles", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        arriving.select(
            "*",
            F.col("_metadata.file_name").alias("source_file"),
            F.lit(ingested_date).alias("ingested_date"),
        )
        .writeStream.format("parquet")
        .partitionBy("ingested_date")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_rows(spark: SparkSession, target: str) -> DataFrame:
    """Rows per date and source file of the stream's target."""
    return (
        spark.read.parquet(target)
        .groupBy("ingested_date", "source_file")
        .agg(F.count("*").alias("landed_rows"))
    )
