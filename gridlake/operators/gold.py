"""Gold layer: incremental slices, upserts, and the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.operators import keyindex
from gridlake.operators.lookup import lookup_join
from gridlake.operators.silver import dedupe
from gridlake.session import discard, scratch_dir
from gridlake.sources.sinks import TRANSACTIONAL, overwrite_table, replace_table

# Fixed value: lower bound used while the target is empty.
EARLIEST = "1900-01-01"


def incremental_slice(
    source: DataFrame,
    target: DataFrame | None,
    column: str,
    lookback: str | None = None,
    date_column: str | None = None,
    newest_date: DataFrame | None = None,
) -> DataFrame:
    """Source rows at or after the newest value in the target, less ``lookback`` (an interval such as ``"2 days"``).

    ``target=None`` (first load or full refresh) keeps every row, also those with a NULL ``column``. The bound stays a
    scalar subquery. When the tables are partitioned by the date of ``column``, name that column as ``date_column``: the
    source then reads only partitions from the bound on. ``newest_date`` (one value, such as :func:`newest_partition`
    gives) says which partition of the target is its last; otherwise the date is looked for in all of them.
    """
    if target is None:
        return source
    bound = _bound(target, column, lookback, date_column, newest_date)
    rows = source.where(F.col(column) >= bound.scalar())
    if date_column:
        rows = rows.where(F.col(date_column) >= bound.select(F.to_date("bound")).scalar())
    return rows


def late_rows(
    source: DataFrame, target: DataFrame, column: str, lookback: str | None = None, date_column: str | None = None
) -> DataFrame:
    """Source rows that :func:`incremental_slice` leaves out: older than its bound, or with a NULL ``column``."""
    bound = _bound(target, column, lookback, date_column).scalar()
    return source.where((F.col(column) < bound) | F.col(column).isNull())


def newest_partition(spark: SparkSession, table: str, column: str) -> DataFrame:
    """The largest value of a partition column, from the catalog's list of partitions; no file is opened."""
    kind = spark.table(table).schema[column].dataType
    value = F.regexp_extract("partition", rf"(?:^|/){column}=([^/]*)", 1)
    known = F.when(value != "__HIVE_DEFAULT_PARTITION__", value).cast(kind)
    return spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(known).alias(column))


def _bound(
    target: DataFrame,
    column: str,
    lookback: str | None,
    date_column: str | None = None,
    newest_date: DataFrame | None = None,
) -> DataFrame:
    kind = target.schema[column].dataType
    if date_column and (date_column != column or newest_date is not None):
        newest_date = target.agg(F.max(date_column)) if newest_date is None else newest_date
        target = target.where(F.col(date_column) == newest_date.scalar())
    newest = F.coalesce(F.max(column), F.lit(EARLIEST).cast(kind))
    if lookback:
        newest = (newest - F.expr(f"INTERVAL {lookback}")).cast(kind)
    return target.agg(newest.alias("bound"))


def unique_batch(
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The batch with one row per key.

    ``latest`` keeps the last row by ``order_by``. ``error`` fails the job on a repeated key. A NULL key or partition
    always fails it: such rows match nothing in the target and would pile up with every replay.
    """
    missing = F.lit(False)
    for key in [*keys, *partition_by]:
        missing = missing | F.col(key).isNull()
    if on_duplicate == "latest":
        rows, repeated = dedupe(batch, keys, order_by, "latest"), F.lit(False)
    elif on_duplicate == "error":
        others = [c for c in batch.columns if c not in keys]
        rows = (
            batch.groupBy(*keys)
            .agg(F.any_value(F.struct(*others)).alias("__row"), F.count(F.lit(1)).alias("__n"))
            .select(*keys, *[F.col("__row")[c].alias(c) for c in others], "__n")
        )
        repeated = F.col("__n") > 1
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    checked = (
        F.when(missing, F.raise_error(F.lit(f"NULL in upsert key {list(keys)}")).cast("boolean"))
        .when(repeated, F.raise_error(F.lit(f"repeated upsert key {list(keys)}")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return rows.where(checked).select(*batch.columns)


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The target after the batch: rows with a key of the batch are replaced, the rest stay. Replays change nothing."""
    rows = unique_batch(batch, keys, on_duplicate, order_by)
    if target is None:
        return rows
    kept = target.join(rows.select(*keys), list(keys), "left_anti")
    return kept.unionByName(rows.select(*target.columns))


def upsert_table(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    key_moves: bool = False,
    fmt: str = "parquet",
) -> list | None:
    """Upsert ``batch`` into ``table``, creating it on first use.

    Formats with MERGE use it. Otherwise only the partitions named in the batch are read and rewritten, which needs the
    partition to be a function of the key. ``key_moves=True`` is for tables where a key may change partition (dimension
    snapshots): the partitions that hold the batch's keys now are rewritten as well, as the table's index of keys tells
    (:mod:`gridlake.operators.keyindex`). A table without partitions is rewritten whole. New rows are staged on shared
    storage before the table is touched, as a job must not overwrite what it reads.

    Returns the values of the first partition column whose partitions were written, or None for the whole table.
    """
    if not spark.catalog.tableExists(table):
        keyindex.drop(spark, table)
        replace_table(unique_batch(batch, keys, on_duplicate, order_by, partition_by), table, partition_by, fmt)
        return None
    if fmt in TRANSACTIONAL:
        _merge(spark, table, unique_batch(batch, keys, on_duplicate, order_by), keys)
        return None
    target = spark.table(table)
    with ExitStack() as stack:
        if not partition_by:
            rows = staged(spark, upsert(target, batch, keys, on_duplicate, order_by), stack)
            overwrite_table(rows, table, "static")
            return None
        batch = staged(spark, unique_batch(batch, keys, on_duplicate, order_by, partition_by), stack)
        if key_moves:
            return _upsert_moving(spark, table, batch, keys, partition_by, fmt, stack)
        values = named(batch, partition_by)
        kept = target.where(F.col(partition_by[0]).isin(values)).join(batch.select(*keys), list(keys), "left_anti")
        rewritten = staged(spark, kept.unionByName(batch.select(*target.columns)), stack)
        overwrite_table(rewritten.hint("rebalance", *[F.col(c) for c in partition_by]), table, "dynamic")
        return values


def _upsert_moving(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    fmt: str,
    stack: ExitStack,
) -> list:
    """Rewrite the partitions that the batch names and those that hold its keys now; drop the ones that this empties."""
    first, copy = partition_by[0], lambda df: staged(spark, df, stack)
    buckets = keyindex.open_index(spark, table, keys, first, fmt)
    old = keyindex.moved_from(spark, table, batch, keys, first, buckets)
    new = named(batch, partition_by)
    keyindex.announce(spark, batch, table, keys, first, buckets, copy)
    target = spark.table(table)
    kept = target.where(F.col(first).isin({*old, *new})).join(batch.select(*keys), list(keys), "left_anti")
    rewritten = copy(kept.unionByName(batch.select(*target.columns)))
    # A partition that the batch names has its rows; with one column, only the others can be emptied.
    chosen = sorted({*old, *new} if len(partition_by) > 1 else {*old} - {*new})
    held = lambda df: {tuple(r) for r in df.where(F.col(first).isin(chosen)).select(*partition_by).distinct().collect()}
    gone = held(target) - held(rewritten) if chosen else set()
    overwrite_table(rewritten.hint("rebalance", *[F.col(c) for c in partition_by]), table, "dynamic")
    for values in sorted(gone):
        spec = ", ".join(f"{c} = '{v}'" for c, v in zip(partition_by, values, strict=True))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    keyindex.settle(spark, batch, table, keys, first, buckets, copy)
    return sorted({*old, *new})


def touched(target: DataFrame, batch: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows that may have to be rewritten: those with a value of the first partition column that the batch names.

    The values are put into the filter, so only those partitions are read. There are no more of them than the table has,
    or gets, partitions, which the catalog lists for the driver anyway.
    """
    return target.where(F.col(partition_by[0]).isin(named(batch, partition_by)))


def named(batch: DataFrame, partition_by: Sequence[str]) -> list:
    """The values of the first partition column in the batch."""
    return [row[0] for row in batch.select(partition_by[0]).distinct().collect()]


def staged(spark: SparkSession, df: DataFrame, stack: ExitStack) -> DataFrame:
    """A copy on shared storage, deleted when ``stack`` is left."""
    folder = scratch_dir(spark, "stage")
    stack.callback(discard, spark, folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _merge(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str]) -> None:
    matches = [F.col(f"target.{k}") == F.col(f"batch.{k}") for k in keys]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    rows.alias("batch").mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()


def build_incremental(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    column: str,
    partition_by: Sequence[str] = (),
    lookback: str | None = None,
    date_column: str | None = None,
    full_refresh: bool = False,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    key_moves: bool = False,
    fmt: str = "parquet",
) -> list | None:
    """An incremental model: slice the source against the table as it is, then upsert the slice.

    Returns what :func:`upsert_table` returns.
    """
    exists = spark.catalog.tableExists(table)
    if full_refresh or not exists:
        keyindex.drop(spark, table)
        replace_table(unique_batch(source, keys, on_duplicate, order_by, partition_by), table, partition_by, fmt)
        return None
    newest = newest_partition(spark, table, date_column) if date_column and date_column in partition_by else None
    rows = incremental_slice(source, spark.table(table), column, lookback, date_column, newest)
    return upsert_table(spark, table, rows, keys, partition_by, on_duplicate, order_by, key_moves, fmt)


def fact_rows(silver: DataFrame) -> DataFrame:
    """Fact columns of the silver table."""
    return silver.select("trading_interval", "unit_id", "generated_mw", "trading_date", "fuel_type")


def dim_unit_rows(register: DataFrame) -> DataFrame:
    """Unit dimension rows; the station name is the unit's name."""
    return register.select("unit_id", "trading_date", F.col("station_name").alias("unit_name"), "region_id")


def dim_region_rows(register: DataFrame) -> DataFrame:
    return register.select("region_id", "trading_date", "region_name")


def star(fact: DataFrame, dim_unit: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Fact rows with unit and region names; a dimension that repeats a key fails the job, so no row is multiplied."""
    units = lookup_join(dim_unit.select("unit_id", "unit_name", "region_id"), dim_region, ["region_id"], ["region_name"])
    return lookup_join(fact, units, ["unit_id"], ["unit_name", "region_id", "region_name"])


def star_generation(fact: DataFrame, dim_unit: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Generation per region and fuel.

    The fact is added up per unit and fuel before it meets the dimensions, so the join sees one row per unit and fuel
    and a unit with very many rows is reduced by the map-side aggregate.
    """
    per_unit = fact.groupBy("unit_id", "fuel_type").agg(
        F.sum("generated_mw").alias("__mw"), F.count(F.lit(1)).alias("__n")
    )
    return (
        star(per_unit, dim_unit, dim_region)
        .groupBy("region_name", "fuel_type")
        .agg(F.sum("__mw").alias("generated_mw"), F.sum("__n").alias("n"))
    )


def generation_by_unit_fuel(df: DataFrame) -> DataFrame:
    """Generation per interval, unit and fuel."""
    return df.groupBy("trading_interval", "unit_id", "fuel_type").agg(F.sum("generated_mw").alias("generated_mw"))


