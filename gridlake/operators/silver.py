"""Silver layer: one row per key, station names, and the share of one fuel per interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.operators.lookup import is_small, lookup_join


def dedupe(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep: str = "latest"
) -> DataFrame:
    """One row per key; NULL keys count as equal.

    ``latest`` and ``first`` choose by ``order_by``, ``any`` takes an arbitrary row. ``row_number() = 1`` lets Spark put
    a group limit in front of the exchange, so each map task sends at most one row per key however many copies a key
    has.
    """
    if keep == "any":
        return df.dropDuplicates(list(keys))
    if not order_by:
        raise ValueError("keep='latest' and keep='first' need order_by")
    direction = {"latest": F.desc_nulls_last, "first": F.asc_nulls_last}[keep]
    ranked = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order_by])
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def enrich(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Sequence[str],
    dim_order: Sequence[str] | None = None,
) -> DataFrame:
    """Left join of ``columns`` from a lookup table; never changes the number of input rows.

    The lookup is reduced to one row per key first: the latest by ``dim_order``, or the first by its columns. See
    :func:`gridlake.operators.lookup.lookup_join` for how hot keys and large lookups are joined.
    """
    order, keep = (list(dim_order), "latest") if dim_order else (list(columns), "first")
    lookup = dedupe(dim.select(on, *dict.fromkeys([*columns, *order])), [on], order, keep)
    return lookup_join(df, lookup, [on], columns, small=is_small(dim.select(on, *columns)), unique=True)


def share_expression(value: str, label: str, match: str, fill_zero: bool = False) -> Column:
    """Sum of ``value`` where ``label`` equals ``match`` over the sum of all; NULL for no match or a zero total."""
    part = F.sum(F.when(F.col(label) == match, F.col(value)))
    if fill_zero:
        part = F.coalesce(part, F.lit(0.0))
    return F.try_divide(part, F.sum(value))


def fuel_share(
    df: DataFrame,
    group: str = "trading_interval",
    value: str = "generated_mw",
    label: str = "fuel_type",
    match: str = "Solar",
    name: str = "solar_share",
    fill_zero: bool = False,
    time_name: str = "event_time",
) -> DataFrame:
    """Share of one fuel in the generation of each interval."""
    share = share_expression(value, label, match, fill_zero).alias(name)
    return df.groupBy(group).agg(share).withColumnRenamed(group, time_name)


def clean_dispatch(
    dispatch: DataFrame,
    units: DataFrame,
    order_by: Sequence[str] = ("ingested_at",),
    keep: str = "latest",
    unit_order: Sequence[str] | None = None,
) -> DataFrame:
    """The silver table: dispatch rows unique on (trading_interval, unit_id) with ``station_name``."""
    rows = dedupe(dispatch, ["trading_interval", "unit_id"], order_by, keep)
    return enrich(rows, units, "unit_id", ["station_name"], unit_order)
