"""Payload feeds: pass a payload on only when it differs from the one before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.ordered import previous


def with_checksum(df: DataFrame, content: str, name: str = "crc") -> DataFrame:
    """CRC-32 of the payload bytes, unsigned."""
    payload = F.col(content)
    if not isinstance(df.schema[content].dataType, T.BinaryType):
        payload = F.encode(payload, "UTF-8")
    return df.withColumn(name, F.crc32(payload))


def changed_payloads(
    df: DataFrame, feed: Sequence[str], arrival: str, content: str, width: str | int, ties: Sequence[str] = ()
) -> DataFrame:
    """Payloads whose checksum differs from the previous one of their feed: A, A, B, A gives A, B, A.

    Only the checksum travels through the ordered scan; the payload column goes along in the row but is never compared.
    ``width`` is the stretch of the arrival axis one task handles (a duration, or a count for integer arrivals).
    """
    marked = previous(with_checksum(df, content, "__crc"), feed, arrival, {"__before": "__crc"}, width, ties)
    return marked.where(~F.col("__crc").eqNullSafe(F.col("__before"))).select(*df.columns)


def decode_payload(df: DataFrame, content: str) -> DataFrame:
    """Binary payload to text."""
    return df.withColumn(content, F.decode(F.col(content), "UTF-8"))
