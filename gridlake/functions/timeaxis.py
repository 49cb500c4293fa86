"""Expressions on the ordering axis of a series (timestamps or integers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds per unit.
MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(text: str) -> int:
    """Length of a duration such as ``"30 minutes"`` or ``"1 day 12 hours"``."""
    words = text.split()
    total = sum(int(n) * MICROS[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2], strict=True))
    if total <= 0:
        raise ValueError(f"duration must be positive: {text!r}")
    return total


def span(width: str | int) -> int:
    """Width on the axis: a duration for timestamps, a plain count for integers."""
    return width if isinstance(width, int) else micros(width)


def position(df: DataFrame, column: str) -> Column:
    """``column`` as a bigint position: epoch microseconds for timestamps and dates, the value for integers."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    return F.unix_micros(F.col(column).cast("timestamp"))


def floor_to(value: Column, width: int) -> Column:
    """Largest multiple of ``width`` that is not above ``value`` (also for negative positions)."""
    return value - F.pmod(value, F.lit(width))


def shift(column: Column, duration: str) -> Column:
    """``column`` moved by a fixed duration; keeps the timestamp type, with or without zone."""
    seconds, rest = divmod(abs(signed := _signed(duration)), 1_000_000)
    moved = F.make_dt_interval(secs=F.lit(f"{seconds}.{rest:06d}").cast("decimal(18,6)"))
    return column + moved if signed >= 0 else column - moved


def _signed(duration: str) -> int:
    return -micros(duration[1:]) if duration.startswith("-") else micros(duration)


def interval_start(ts: Column | str, width: str) -> Column:
    """Start of the epoch-aligned interval that holds ``ts``; keeps TIMESTAMP_NTZ."""
    return F.window(ts, width)["start"]


def steps_after(ts: Column, step: str, number: Column) -> Column:
    """``ts`` plus ``number`` steps."""
    seconds = micros(step) / 1_000_000
    return ts + F.make_dt_interval(secs=(number * F.lit(seconds)).cast("decimal(18,6)"))


def iso_text(ts: Column) -> Column:
    """ISO text to the second, with microseconds only when there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def slot_of_day(position_micros: Column, step: str) -> Column:
    """Number of the step within its UTC day."""
    width = micros(step)
    return F.floor(F.pmod(position_micros, F.lit(MICROS["day"])) / width).cast("int")
