"""Writers. All replace the target as a whole, so a load that is repeated gives the same table.

Stored tables are replaced by versions (``versions.py``): the old rows stay until the new ones are all there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.wire import encode_messages
from riskflow.sources.versions import replace

# Fixed value: column files are compressed with zstd.
COMPRESSION = "zstd"
# Text files that a later step reads again are compressed, and hold so many rows at most, since such a file
# is read by one task.
PACKED = {"compression": "gzip", "maxRecordsPerFile": "100000"}
# Into how many pieces rows of one sort key can be cut.
PIECES = 4096


def plain_number(c: Column) -> Column:
    """A double as text without an exponent where 38 digits hold it, so that strict casts read it back."""
    text = c.cast("string")
    digits = text.try_cast("decimal(38,12)").cast("string")
    short = F.regexp_replace(digits, r"(\.\d+?)0+$", "$1")
    # nested, because all of a condition's parts that come twice are computed for every row
    plain = F.when(digits.isNotNull() & (digits.try_cast("double") == c), short).otherwise(text)
    return F.when(text.contains("E"), plain).otherwise(text)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    """CSV files with a header; blanks at the ends of a value are kept, doubles are written as plain decimals."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    plain = [plain_number(F.col(n)).alias(n) if isinstance(k, T.DoubleType) else F.col(n) for n, k in kinds.items()]
    writer = df.select(*plain).write.mode("overwrite").options(**options).option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_messages(df: DataFrame, path: str) -> None:
    """One JSON object per row, as text lines."""
    encode_messages(df).write.mode("overwrite").text(path)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """One JSON object per row, to a Kafka topic (needs the Kafka connector on the class path)."""
    writer = encode_messages(df).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order and types of the target table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_refresh(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Replace the table at ``path`` and return it as stored."""
    return replace(conform(df, schema) if schema else df, path, COMPRESSION)


def write_distributed(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Replace the table at ``path`` with rows of equal keys stored together.

    The hint, unlike a plain repartition, lets adaptive execution cut a partition that a hot key makes too
    large and join those that are too small.
    """
    return write_refresh(df.hint("rebalance", *keys), path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Replace a catalog table that is bucketed by ``key``, for joins without a shuffle.

    Rows come to the writers one bucket per partition, so a bucket is one file; adaptive execution cuts a
    bucket that a hot key makes too large into several. A join reads a bucket in one task, so for keys with
    hot values use ``fan_out_join``, which does not rely on buckets.
    """
    spread = df.hint("rebalance", buckets, key)
    writer = spread.write.mode("overwrite").format("parquet").option("compression", COMPRESSION)
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def sort_ranges(
    df: DataFrame, key: str, partitions: int | None = None, spread: Sequence[str] | None = None
) -> DataFrame:
    """Partitions that cover disjoint ranges of ``key``, each sorted by it.

    Rows of one key are cut into pieces by a hash of the ``spread`` columns (by default all) and of the task
    that read the row, so neither a hot key nor a group of copies fills one partition. Finding the ranges
    takes a pass over ``df``, so pass a stored table and compute further columns afterwards.
    """
    piece = F.pmod(F.xxhash64(*(spread or df.columns), F.spark_partition_id()), F.lit(PIECES))
    count = [partitions] if partitions else []  # without a number, adaptive execution may merge small ranges
    ranged = df.withColumn("_piece", piece).repartitionByRange(*count, key, "_piece")
    return ranged.sortWithinPartitions(key, "_piece").drop("_piece")


def write_sorted(
    df: DataFrame, path: str, key: str, partitions: int | None = None, spread: Sequence[str] | None = None
) -> DataFrame:
    """Replace the table at ``path`` with files that cover disjoint ranges of ``key`` and are sorted by it.

    Readers skip files and row groups by their key range.
    """
    return write_refresh(sort_ranges(df, key, partitions, spread), path)
