"""Left join with a lookup that has one row per key, safe against hot keys and against lookups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lookups up to this size are broadcast. Beyond, keys with more than one in HOT_SHARE of all rows are salted; there can be
# no more than HOT_SHARE of them.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1000
SALTS = 64


def is_small(df: DataFrame) -> bool:
    """Whether ``df`` has at most ``BROADCAST_ROWS`` rows and about ``BROADCAST_BYTES``; looks no further than that."""
    width = F.lit(0).cast("bigint")
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(value)
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + 8
            continue
        width = width + F.coalesce(F.octet_length(value), F.lit(0))
    seen = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return seen["n"] <= BROADCAST_ROWS and (seen["size"] or 0) <= BROADCAST_BYTES


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    small: bool | None = None,
    unique: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``columns`` of ``lookup``; a NULL in ``on`` matches nothing.

    A key that the lookup repeats fails the job, as it would multiply rows; ``unique`` says that the lookup has been
    reduced already. ``small`` is what the caller knows: True broadcasts the lookup, None measures it first (for lookups
    that are cheap to read), False leaves the choice to the adaptive planner, which sees the real size at run time.

    Without a broadcast, rows of hot keys and rows without a key are spread over ``SALTS`` salts, and the hot keys'
    lookup rows are repeated for each, so that one join does for all. (The adaptive planner alone does not split such a
    join, as the lookup's own aggregate fixes its partitioning.) Hot keys are found by a count of the key columns,
    combined before it is shuffled; ``counts`` (keys and ``n``) may bring one.
    """
    keys = list(on)
    lookup = lookup.where(_all_present(keys)).select(*keys, *columns)
    if small is None:
        small = is_small(lookup)
    if not unique:
        lookup = one_per_key(lookup, keys)
    if small:
        return df.join(F.broadcast(lookup), keys, "left").select(*df.columns, *columns)
    hot = F.broadcast(hot_keys(df, keys, counts).withColumn("__hot", F.lit(True)))
    spread = F.col("__hot") | ~_all_present(keys)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    rows = df.join(hot, keys, "left").withColumn("__salt", F.when(spread, salt).otherwise(F.lit(0).cast("bigint")))
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    every = F.coalesce(salts, F.array(F.lit(0).cast("bigint")))
    repeated = lookup.join(hot, keys, "left").withColumn("__salt", F.explode(every)).drop("__hot")
    return rows.join(repeated, [*keys, "__salt"], "left").select(*df.columns, *columns)


def one_per_key(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The lookup itself; a key that comes again fails the job."""
    others = [c for c in lookup.columns if c not in keys]
    counted = lookup.groupBy(*keys).agg(F.any_value(F.struct(*others)).alias("__row"), F.count(F.lit(1)).alias("__n"))
    message = F.concat(F.lit(f"repeated lookup key {list(keys)}: "), F.to_json(F.struct(*keys)))
    alone = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.where(alone).select(*keys, *[F.col("__row")[c].alias(c) for c in others])


def hot_keys(df: DataFrame, keys: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Keys with more than one in ``HOT_SHARE`` of all rows that have a key: at most ``HOT_SHARE`` keys."""
    if counts is None:
        counts = df.where(_all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.where(F.col("n") * HOT_SHARE > total).select(*keys)


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present
