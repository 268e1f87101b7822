"""Landing of message streams: raw bodies as JSON files, then the typed table rebuilt from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskflow.functions.wire import decode_messages, typed_columns
from riskflow.operators.clean import drop_missing_key
from riskflow.schemas import ENTITIES, Entity
from riskflow.session import together
from riskflow.sources.readers import message_text, read_json, read_text_csv
from riskflow.sources.writers import PACKED, write_csv

ENVELOPE = T.StructType([T.StructField("raw_data", T.StringType(), True)])


def land(messages: DataFrame, raw_path: str, checkpoint_path: str, seconds: float | None = None) -> None:
    """Append all messages that are available now to compressed JSON files; returns when all have landed.

    With ``seconds``, a run that takes longer is stopped and raises ``TimeoutError``, so that no batch step works on
    part of the messages. The checkpoint holds the progress: a later run goes on where this one stopped, and a batch
    that was cut off is written again without duplicates, because readers trust the sink's own list of finished files.
    """
    writer = message_text(messages).writeStream.format("json").outputMode("append").options(**PACKED)
    writer = writer.option("path", raw_path).option("checkpointLocation", checkpoint_path)
    query = writer.trigger(availableNow=True).start()
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"not all messages had landed in {raw_path} after {seconds} seconds; run again to go on")


def parse_landed(raw: DataFrame, entity: Entity, drop_keyless: bool = True) -> DataFrame:
    """Landed messages as a typed table; messages without a key are dropped unless told otherwise."""
    rows = decode_messages(raw, entity.wire_schema)
    if drop_keyless:
        rows = drop_missing_key(rows, entity.key)
    return rows.select(*typed_columns(entity.wire_schema, entity.typed_schema))


def ingest(
    spark: SparkSession,
    messages: DataFrame,
    entity: Entity,
    root: str,
    drop_keyless: bool = True,
    seconds: float | None = None,
) -> DataFrame:
    """Land the messages below ``root`` and return the typed table over everything landed so far.

    Fails without a result if a limit in ``seconds`` is given and not kept.
    """
    raw_path = f"{root}/{entity.name}/raw_json"
    land(messages, raw_path, f"{root}/{entity.name}/checkpoint", seconds)
    return parse_landed(read_json(spark, raw_path, ENVELOPE), entity, drop_keyless)


def ingest_to_csv(spark: SparkSession, messages: DataFrame, entity: Entity, root: str) -> str:
    """Ingest and rebuild the CSV files of the entity; returns their path.

    They are compressed unless values hold line breaks: those files are read in blocks, which only plain ones have.
    """
    path = f"{root}/{entity.name}/csv_files"
    write_csv(ingest(spark, messages, entity, root), path, **({} if entity.multiline else PACKED))
    return path


def raw_from_messages(spark: SparkSession, messages: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Ingest the streams of all entities at the same time and expose the results as text tables.

    The text tables are the input of a refresh.
    """

    def load(name: str) -> DataFrame:
        return read_text_csv(spark, ingest_to_csv(spark, messages[name], ENTITIES[name], root), ENTITIES[name])

    return together({name: lambda n=name: load(n) for name in messages})
