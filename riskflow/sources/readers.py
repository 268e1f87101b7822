"""Readers. No reader infers a schema unless asked to: inference would read the data a second time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import Entity
from riskflow.sources.records import ESCAPE, read_records
from riskflow.sources.versions import current, read_version

# Replay from the start and go on when the broker has dropped old messages.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A stream of a Kafka topic (needs the Kafka connector on the class path).

    A topic with few partitions is split further with ``minPartitions``; ``maxOffsetsPerTrigger`` bounds the
    size of a batch.
    """
    reader = spark.readStream.format("kafka").options(**KAFKA_DEFAULTS)
    named = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    return reader.options(**named).options(**options).load()


def file_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A stream of text files with one message per line; ``maxFilesPerTrigger`` bounds the size of a batch."""
    return spark.readStream.options(**options).text(path)


def message_text(messages: DataFrame, name: str = "raw_data") -> DataFrame:
    """The message bodies as text."""
    return messages.selectExpr(f"CAST(value AS STRING) AS {name}")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a known schema."""
    return spark.read.schema(schema).json(path)


def read_json_inferred(spark: SparkSession, path: str, fallback: T.StructType) -> DataFrame:
    """JSON lines with an inferred schema, or with ``fallback`` where nothing can be inferred.

    That is the case for an empty folder and for files without a readable object.
    """
    try:
        inferred = spark.read.json(path)
    except AnalysisException:
        return read_json(spark, path, fallback)
    usable = [c for c in inferred.columns if c != "_corrupt_record"]
    return inferred if usable else read_json(spark, path, fallback)


def _csv(spark: SparkSession, path: str, entity: Entity, schema: T.StructType) -> DataFrame:
    options = {"mode": "PERMISSIVE", "escape": ESCAPE}
    if not entity.multiline:
        return spark.read.schema(schema).option("header", True).options(**options).csv(path)
    # Spark's own reader takes a whole file per task where values hold line breaks
    parsed = read_records(spark, path).select(F.from_csv("record", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields), options).alias("r"))
    return parsed.select(*[F.col("r")[n].alias(n) for n in schema.fieldNames()])


def read_text_csv(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """CSV files with a header, every column as text."""
    return _csv(spark, path, entity, entity.text_schema)


def read_typed_csv(spark: SparkSession, path: str, entity: Entity, types: Mapping[str, T.DataType]) -> DataFrame:
    """CSV files with a header, some columns typed while reading; text that does not fit gives null."""
    fields = [T.StructField(n, types.get(n, T.StringType()), True) for n in entity.wire]
    return _csv(spark, path, entity, T.StructType(fields))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table in ``partitions`` parallel ranges of ``column``; filters and column choice push down."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    ranges = {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": str(partitions)}
    return reader.options(**ranges).options(**dict(properties or {})).load()


def read_table(spark: SparkSession, source: str | Mapping[str, object]) -> DataFrame:
    """One entry for stored tables: a path, a catalog name, or the arguments of ``read_jdbc``.

    A path with versions gives the current one, any other path its parquet files.
    """
    if isinstance(source, Mapping):
        return read_jdbc(spark, **source)
    if "/" in source:
        found = current(spark, source)
        return read_version(spark, source, found) if found else spark.read.parquet(source)
    return spark.table(source)
