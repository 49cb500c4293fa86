"""Explicit schemas of the messages and tables. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

DISPATCH_MESSAGE = T.StructType(
    [
        T.StructField("trading_interval", T.TimestampType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("generated_mw", T.DoubleType()),
        T.StructField("fuel_type", T.StringType()),
    ]
)

# Where and when a message arrived: its time, its topic partition or file, and its place there. Structs compare field by
# field, so the largest one is the last arrival.
ARRIVAL = T.StructType(
    [
        T.StructField("time", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)

# A log of messages kept in files, as a broker would deliver them.
MESSAGE_LOG = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

BRONZE = T.StructType(
    DISPATCH_MESSAGE.fields
    + [
        T.StructField("trading_date", T.DateType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("arrival", ARRIVAL),
    ]
)

SILVER = T.StructType(BRONZE.fields + [T.StructField("station_name", T.StringType())])

UNIT_METADATA = T.StructType(
    [
        T.StructField("unit_id", T.StringType()),
        T.StructField("fuel_type", T.StringType()),
        T.StructField("station_name", T.StringType()),
    ]
)

REGION_METADATA = T.StructType(
    [T.StructField("region_id", T.StringType()), T.StructField("region_name", T.StringType())]
)

# The wider unit and region files that can feed the star schema (see ``operators.gold.dim_unit_rows``).
UNIT_REGISTER = T.StructType(
    UNIT_METADATA.fields
    + [T.StructField("region_id", T.StringType()), T.StructField("trading_date", T.DateType())]
)
REGION_REGISTER = T.StructType(REGION_METADATA.fields + [T.StructField("trading_date", T.DateType())])

SHARE_MESSAGE = T.StructType(
    [T.StructField("event_time", T.StringType()), T.StructField("solar_share", T.DoubleType())]
)

FORECAST_MESSAGE = T.StructType(
    [T.StructField("event_time", T.StringType()), T.StructField("forecast_solar_share", T.DoubleType())]
)


def with_ntz(schema: T.StructType) -> T.StructType:
    """The same schema with zoneless timestamps."""
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
            for f in schema
        ]
    )


def with_type(schema: T.StructType, **types: T.DataType) -> T.StructType:
    """The same schema with the named fields retyped."""
    return T.StructType([T.StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in schema])
