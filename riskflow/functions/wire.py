"""The JSON wire format: one JSON object per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_datetime(c: Column | str) -> Column:
    """ISO date-time text; the fraction is written only where there is one."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(c, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def encode_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as one JSON object: date-times in ISO form, dates as yyyy-MM-dd, the rest unchanged."""
    fields = []
    for f in df.schema.fields:
        is_time = isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        fields.append((iso_datetime(F.col(f.name)) if is_time else F.col(f.name)).alias(f.name))
    options = {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}
    return df.select(F.to_json(F.struct(*fields), options).alias(value))


def decode_messages(df: DataFrame, schema: T.StructType, value: str = "raw_data") -> DataFrame:
    """Parse the JSON column and flatten its fields; where the column is absent the rows are flat already."""
    if value not in df.columns:
        return df.select(*[f.name for f in schema.fields])
    # inline, because a filter on a field would else be pushed below the parse and parse every message again
    return df.select(F.inline(F.array(F.from_json(F.col(value), schema))))


def typed_columns(given: T.StructType, target: T.StructType) -> list[Column]:
    """The fields of ``target``, cast where the given type differs; what does not fit is null."""
    return [
        (F.col(f.name) if given[f.name].dataType == f.dataType else F.col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in target.fields
    ]
