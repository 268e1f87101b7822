"""CSV records that may hold line breaks, from files that are read in blocks.

A line break inside quotes does not end a record, and whether a line starts inside quotes depends on all lines before
it. Lines are therefore read as text, which splits at any offset; the quotes of each block are counted, one row per
block tells whether a block starts inside quotes, and from there each line knows its record. Only the records that
cross a border of blocks are put together in a second step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How values with commas, quotes and line breaks are written.
QUOTE, ESCAPE = '"', "\\"


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(file, block, nth, record) of all records of CSV files; a file feeds as many tasks as it has blocks.

    ``block`` is the offset at which the record's block starts and ``nth`` counts the records that start in it, from 1.
    With ``header`` the first record of each file is left out; blank records always are. Quotes within a value must be
    escaped, as the writer does. A record ends at a line feed outside quotes; a carriage return before it is cut off.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),  # rises along the lines of a block
        F.col("value").alias("line"),
    )
    bare = F.regexp_replace("line", r"\\.", "")
    lines = lines.withColumn("quotes", F.regexp_count(bare, F.lit(QUOTE)).cast("long"))

    per_block = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per block
    states = per_block.select("file", "block", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("open"))

    in_block = Window.partitionBy("file", "block").orderBy("place")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    known = lines.join(states, ["file", "block"])
    started = (F.col("open") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 0
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = known.withColumn("starts", started.cast("long")).withColumn("nth", F.sum("starts").over(upto))
    parts = numbered.groupBy("file", "block", "nth").agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
    parts = parts.withColumn("text", F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).drop("lines")

    # the lines of a block before its first record belong to the last record that starts in a block before
    ends = numbered.groupBy("file", "block").agg(F.max("nth").alias("last"), F.max("open").alias("open"))
    ordered = Window.partitionBy("file").orderBy("block")
    owner = F.last(F.when(F.col("last") > 0, F.struct("block", "last")), ignorenulls=True).over(earlier)
    ends = ends.select(
        "file",
        "block",
        "last",
        F.coalesce(F.lead("open").over(ordered) == 1, F.lit(False)).alias("goes_on"),
        owner.alias("owner"),
    )
    placed = parts.join(ends, ["file", "block"])
    loose = (F.col("nth") == 0) | (F.col("goes_on") & (F.col("nth") == F.col("last")))
    whole = placed.where(~loose).select("file", "block", "nth", F.col("text").alias("record"))
    crossing = placed.where(loose).select(
        "file",
        F.when(F.col("nth") == 0, F.col("owner.block")).otherwise(F.col("block")).alias("of_block"),
        F.when(F.col("nth") == 0, F.col("owner.last")).otherwise(F.col("nth")).alias("nth"),
        F.struct("block", "text").alias("part"),
    )
    joined = crossing.groupBy("file", "of_block", "nth").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    stitched = joined.select("file", F.col("of_block").alias("block"), "nth", F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("record"))
    records = whole.unionByName(stitched).withColumn("record", F.regexp_replace("record", "\r$", ""))
    if header:
        records = records.where((F.col("block") > 0) | (F.col("nth") > 1))
    return records.where(F.trim("record") != "")
