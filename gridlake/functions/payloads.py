"""JSON message fields to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The fields of one JSON object per message; absent fields and text that is no JSON give NULL."""
    kept = [c for c in df.columns if c != value]
    return df.select(*kept, F.from_json(F.col(value).cast("string"), schema).alias("data")).select(*kept, "data.*")


def to_time(text: Column | str, zoneless: bool = False) -> Column:
    """ISO text, with a blank or a T between date and time, to a timestamp; NULL when it is neither."""
    kind = "timestamp_ntz" if zoneless else "timestamp"
    return (F.col(text) if isinstance(text, str) else text).try_cast(kind)


def parse_shares(
    df: DataFrame, schema: T.StructType, time: str, share: str, zoneless: bool = False, observed_as: str | None = None
) -> DataFrame:
    """Share messages as ``(time, share)``. Messages without a time or a share cannot be used and are left out.

    With ``observed_as`` a stream reports, per batch and under that name, how many were ``received`` and ``unusable``.
    """
    parsed = parse_json(df, schema).withColumn(time, to_time(time, zoneless))
    usable = F.col(time).isNotNull() & F.col(share).isNotNull()
    if observed_as:
        received, unusable = F.count(F.lit(1)).alias("received"), F.count_if(~usable).alias("unusable")
        parsed = parsed.observe(observed_as, received, unusable)
    return parsed.where(usable)
