r"""CSV records whose quoted fields hold line breaks, read by many tasks per file.

Spark splits a CSV file at line breaks only if none of them lies inside quotes, and otherwise
reads a file in one task. Here the lines are read in splits all the same. Whether a line begins
inside quotes follows from the number of quotes before it: counted within each file block, then
carried over the blocks of a file as one row per block. Lines then meet the line that began
their record, which may lie in an earlier block, and the records are parsed.

This is exact for files that quote as RFC 4180 says: a field with a quote in it is
quoted, and its quotes are doubled. Whether a file does is checked on every record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybeat.sources.tables import staged

#: Stands for a quoted run in the check of a record.
_RUN = "\x01"


def well_formed(text: Column) -> Column:
    """Whether a text is whole records: every quoted run closed, and as wide as its field."""
    rest = F.regexp_replace(F.translate(text, _RUN, " "), '"[^"]*"', _RUN)
    return ~rest.contains('"') & ~rest.rlike(f"[^,{_RUN}]{_RUN}|{_RUN}[^,{_RUN}]")


def _without_return(line: Column) -> Column:
    return F.when(line.endswith("\r"), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line and value of all lines; ``line`` ascends within a block of a file."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
            "value",
        )
    )


def breaks_inside_quotes(spark: SparkSession, path: str) -> bool:
    """Whether some line is not whole records by itself; one scan, nothing is shuffled."""
    own = _without_return(F.col("value"))
    bad = ~well_formed(own) | own.contains("\r")
    return not lines(spark, path).filter(bad).isEmpty()


def assembled(spark: SparkSession, path: str) -> DataFrame:
    """file, block, record and text of every record; the header of a file is record 1 of block 0.

    Two shuffles of the lines: by block, to count quotes in order, and by record. A task holds one
    block or some records, so a file of any size is many tasks.
    """
    in_block = Window.partitionBy("file", "block").orderBy("line")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    counted = staged(
        lines(spark, path)
        .withColumn("quotes", quotes)
        .withColumn("quotes_before", F.coalesce(F.sum("quotes").over(before), F.lit(0))),
        "csv-lines",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("quotes_before") % 2 == 0).alias("even"),
        F.count_if(F.col("quotes_before") % 2 == 1).alias("odd"),
        F.min_by("value", "line").endswith("\r").alias("returns"),
    )
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("begun", F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd")))
    last = F.when(F.col("begun") > 0, F.struct("block", F.col("begun").alias("record")))
    blocks = blocks.withColumn("open", F.last(last, ignorenulls=True).over(earlier))
    # The first line tells how the file ends its lines; its other line ends are read as that one.
    first_line = F.first("returns").over(Window.partitionBy("file").orderBy("block"))
    blocks = blocks.withColumn("returns", first_line).select("file", "block", "inside", "open", "returns")
    begins = ((F.col("inside") + F.col("quotes_before")) % 2 == 0).cast("int")
    placed = counted.join(blocks, ["file", "block"]).withColumn("record", F.sum(begins).over(in_block))
    here = F.struct("block", "record")
    owned = placed.withColumn("owner", F.when(F.col("record") > 0, here).otherwise(F.col("open")))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n")
    return (
        owned.groupBy("file", "owner", "returns")
        .agg(F.when(F.col("returns"), F.replace(_without_return(joined), F.lit("\r\n"), F.lit("\n"))).otherwise(joined).alias("text"))
        .select("file", "owner.block", "owner.record", "text")
    )


def parsed(spark: SparkSession, path: str, whole_files: DataFrame, names: list[str], options: dict[str, str]) -> DataFrame | None:
    """The rows of CSV files with line breaks inside quotes, as ``whole_files`` has them.

    None if a record is not well formed or the headers of the files differ (``names`` are those of
    the first): only the reader of whole files knows what such files mean.
    """
    records = staged(assembled(spark, path), "csv-records")
    is_header = (F.col("block") == 0) & (F.col("record") == 1)
    odd = ~well_formed(F.col("text")) | F.col("text").rlike("\r(?!\n)")
    checked = records.agg(
        F.coalesce(F.bool_or(odd), F.lit(False)).alias("odd"),
        F.min(F.when(is_header, F.col("text"))).alias("first"),
        F.max(F.when(is_header, F.col("text"))).alias("last"),
    ).first()
    if checked.odd or checked.first != checked.last or names != whole_files.columns:
        return None
    rows = records.filter(~is_header & (F.trim("text") != "")).select(
        F.from_csv("text", whole_files.schema.toDDL(), options).alias("row")
    )
    return rows.select("row.*")
