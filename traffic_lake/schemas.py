"""Declared table schemas and casting to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields copied into the raw table, by declared type.
RAW_TEXT = (
    "country city street type subtype roadType turnType endNode alertType reportDescription uuid".split()
)
RAW_FLOAT = "speed length".split()
RAW_INT = (
    "delay severity reportRating confidence reliability jamLevel alertsCount irregularities "
    "driversCount level".split()
)

# The declared flat fields of the processed table, by type.
PROCESSED_TEXT = "country city street type subtype reportBy uuid id".split()
PROCESSED_INT = "reliability confidence nThumbsUp nComments".split()

# The derived groups, which no source document may hold.
DERIVED_FIELDS = ("pig_event_filter", "pig_location_filter", "pig_time_filter")

POINT = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


def _stamps() -> list[T.StructField]:
    return _fields(["source_timestamp", "ingestion_timestamp"], T.TimestampType())


BRONZE = T.StructType(
    [
        T.StructField("mongo_id", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("alert", T.VariantType()),
    ]
)

RAW = T.StructType(
    _fields(["mongo_id", *RAW_TEXT], T.StringType())
    + _fields(["pubMillis"], T.LongType())
    + _fields(RAW_FLOAT, T.FloatType())
    + _fields(RAW_INT, T.IntegerType())
    + [T.StructField("location", POINT)]
    + _stamps()
)

EVENT_FILTER = T.StructType(_fields(["tipo", "subtipo", "prioridad"], T.StringType()))
LOCATION_FILTER = T.StructType(_fields(["ciudad", "zona"], T.StringType()))
TIME_FILTER = T.StructType(
    _fields(["categoria_dia", "dia_semana"], T.StringType())
    + [T.StructField("hora", T.IntegerType()), T.StructField("fecha", T.DateType())]
    + _fields(["timestamp_chile"], T.StringType())
)

PROCESSED = T.StructType(
    _fields(["mongo_id", *PROCESSED_TEXT], T.StringType())
    + _fields(["pubMillis"], T.LongType())
    + _fields(PROCESSED_INT, T.IntegerType())
    + [T.StructField("location", POINT)]
    + _stamps()
    + [
        T.StructField("pig_event_filter", EVENT_FILTER),
        T.StructField("pig_location_filter", LOCATION_FILTER),
        T.StructField("pig_time_filter", TIME_FILTER),
        T.StructField("alert", T.VariantType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: values that do not cast and missing columns become NULL."""
    # Types are compared by name: a cast for the sake of nullability alone would rebuild structs.
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        if f.name not in present:
            column = F.lit(None).cast(f.dataType)
        elif present[f.name] == f.dataType.simpleString():
            column = F.col(f"`{f.name}`")
        else:
            column = F.col(f"`{f.name}`").try_cast(f.dataType)
        columns.append(column.alias(f.name))
    return df.select(*columns)
