"""Which partitions of a table may hold a key, for tables whose keys move between partitions.

The index is a table beside the table: a row for each key and partition, dealt to buckets by the key's hash. An upsert asks
it for the old partitions of its keys, and rewrites these and the new ones only. It may say too much, never too little: the
places that an upsert is going to use are written down as pending before the table is, and count until the index has them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import discard
from gridlake.sources.sinks import overwrite_table, replace_table

# Keys to a bucket when the index is made; a bucket is what the upsert of a single key rewrites of it.
BUCKET_KEYS = 1_000_000
BUCKET = "__bucket"


def index_name(table: str) -> str:
    return f"{table}__keys"


def drop(spark: SparkSession, table: str) -> None:
    """Forget the index of a table that is written anew."""
    if spark.catalog.tableExists(index_name(table)):
        discard(spark, _pending(spark, table)[0])
        spark.sql(f"DROP TABLE {index_name(table)}")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def open_index(spark: SparkSession, table: str, keys: Sequence[str], partition: str, fmt: str = "parquet") -> int:
    """The index's number of buckets. A table without one is read once to make it."""
    name = index_name(table)
    if not spark.catalog.tableExists(name):
        rows = spark.table(table).select(*keys, partition).distinct()
        buckets = max(1, -(-rows.count() // BUCKET_KEYS))
        replace_table(rows.withColumn(BUCKET, bucket_of(keys, buckets)), name, [BUCKET], fmt)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('buckets' = '{buckets}')")
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'buckets'").first()
    return int(properties["value"])


def _buckets(spark: SparkSession, table: str, asked: DataFrame, buckets: int) -> DataFrame:
    """The index's buckets of the keys of ``asked``."""
    rows = spark.table(index_name(table))
    if buckets == 1:
        return rows
    # At most as many as the index has, which the catalog lists.
    chosen = [r[0] for r in asked.select(BUCKET).distinct().collect()]
    return rows.where(F.col(BUCKET).isin(chosen))


def _pending(spark: SparkSession, table: str) -> tuple[str, bool]:
    """The folder of places that an upsert has announced, and whether there is one."""
    name = index_name(table)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    folder = f"{location.rstrip('/')}__pending"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return folder, bool(done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done))


def moved_from(
    spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str], partition: str, buckets: int
) -> list:
    """Partitions that may hold keys of ``batch``; there are no more than the table has."""
    asked = batch.select(*keys, bucket_of(keys, buckets))
    known = _buckets(spark, table, asked, buckets).select(*keys, partition)
    folder, announced = _pending(spark, table)
    if announced:
        known = known.unionByName(spark.read.schema(known.schema).parquet(folder))
    found = known.join(asked.select(*keys), list(keys), "left_semi").select(partition).distinct()
    return [row[0] for row in found.collect()]


def announce(
    spark: SparkSession, batch: DataFrame, table: str, keys: Sequence[str], partition: str, buckets: int, copy: Callable
) -> None:
    """Write down the places of ``batch`` before the table is written. What a stopped upsert announced goes into the index
    first, besides what that says already."""
    folder, announced = _pending(spark, table)
    rows = spark.table(index_name(table))
    if announced:
        left = spark.read.schema(rows.select(*keys, partition).schema).parquet(folder)
        new = left.select(*keys, partition, bucket_of(keys, buckets))
        known = _buckets(spark, table, new, buckets)
        overwrite_table(copy(known.unionByName(new.select(*known.columns)).distinct()), index_name(table))
    batch.select(*rows.select(*keys, partition).columns).coalesce(1).write.mode("overwrite").parquet(folder)


def settle(
    spark: SparkSession, batch: DataFrame, table: str, keys: Sequence[str], partition: str, buckets: int, copy: Callable
) -> None:
    """Once the table is written, the places of ``batch`` are the only ones of its keys. ``copy`` stages rows on shared
    storage, as the index must not overwrite what it reads."""
    new = batch.select(*keys, partition, bucket_of(keys, buckets))
    known = _buckets(spark, table, new, buckets)
    others = known.join(new.select(*keys), list(keys), "left_anti")
    overwrite_table(copy(others.unionByName(new.select(*known.columns))), index_name(table))
    discard(spark, _pending(spark, table)[0])


def rivals(spark: SparkSession, table: str, keys: Sequence[str], partition: str, values: Sequence[object]) -> DataFrame:
    """Rows of ``table`` with a key of the partitions ``values``, wherever they are; only partitions that may hold such
    a key are read."""
    new = spark.table(table).where(F.col(partition).isin(list(values))).select(*keys).distinct()
    buckets = open_index(spark, table, keys, partition)
    held = moved_from(spark, table, new, keys, partition, buckets)
    rows = spark.table(table).where(F.col(partition).isin({*held, *values}))
    return rows.join(new, list(keys), "left_semi")
