"""Writers: catalog tables, message encoding and publishing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.session import discard
from gridlake.streaming.runner import start

# Table formats with row-level MERGE and atomic replacement.
TRANSACTIONAL = ("iceberg", "delta")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")
    return name


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> str:
    """Create the table when it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{parts}")
    return table


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write ``df`` as the whole new content of ``table``. ``df`` must not read ``table`` itself.

    Rows are spread by partition value before the write so that a date becomes a few large files and not one small file
    per task; the exchange is one AQE may split, so a date with a large part of the rows is written by several tasks.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    if fmt in TRANSACTIONAL:
        writer = rows.writeTo(table).using(fmt)
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
        return
    rows.write.format(fmt).mode("overwrite").partitionBy(*partition_by).saveAsTable(table)


def overwrite_table(rows: DataFrame, table: str, mode: str = "dynamic") -> None:
    """Replace the whole content of a table (``static``) or only the partitions that ``rows`` names (``dynamic``)."""
    spark = rows.sparkSession
    # insertInto takes the mode from the session only.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, mode)
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(setting, before)


def replace_view(df: DataFrame, name: str) -> None:
    """A model that is only a view."""
    df.createOrReplaceTempView(name)


def encode_csv(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """One message per row: ``value`` is a quoted CSV line, ``key`` decides the topic partition."""
    return _encoded(df, F.to_csv(F.struct(*columns)), key)


def encode_json(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """One message per row: ``value`` is a JSON object; fields that are NULL are left out."""
    return _encoded(df, F.to_json(F.struct(*columns)), key)


def _encoded(df: DataFrame, value: Column, key: str | None) -> DataFrame:
    keyed = [F.col(key).cast("string").alias("key")] if key else []
    return df.select(*keyed, value.alias("value"))


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, mode: str = "append", **options: str) -> None:
    """Write messages to a topic (``fmt="kafka"``) or as text files that stand for one."""
    out = messages.select("value") if fmt == "text" else messages
    writer = out.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode(mode).save(path)


Writer = Callable[[DataFrame, int], None]


def batch_key(batch: DataFrame, batch_id: int) -> str:
    """Name of a batch that no other stream uses: the query's id, which lives in its checkpoint, and the batch's.

    A new checkpoint counts its batches from 0 again; with the query's id in front it does not meet the old ones.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    return f"{query}-{batch_id}"


def fan_out(
    stream: DataFrame, writers: Mapping[str, Writer], checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Feed one stream to several sinks; the source is read and the plan run once per batch.

    Each writer gets the batch and its id. A writer that overwrites the place belonging to that id makes a replayed
    batch harmless; a plain append is at least once. With several writers the batch is first written next to the
    checkpoint, in one of two folders by turns, so all of them see the same rows, also after the loss of an executor.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if len(writers) > 1:
            # By turns, next to the checkpoint: a stream has one batch at a time.
            folder = f"{checkpoint.rstrip('/')}-batch/{batch_id % 2}"
            batch.write.mode("overwrite").parquet(folder)
            rows = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        for writer in writers.values():
            writer(rows, batch_id)

    return start(stream.writeStream.foreachBatch(write), checkpoint, trigger)


def batch_folder(root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> Writer:
    """Writer that keeps every batch in a folder of its own, replaced when the batch is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{root}/batch_id={batch_key(batch, batch_id)}"
        batch.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(folder)

    return write


def outbox(
    root: str, encode: Callable[[DataFrame], DataFrame], fmt: str = "kafka", path: str | None = None, **options: str
) -> Writer:
    """Writer that publishes each batch as messages which a replay sends again with the same keys.

    A batch is encoded once, into a folder under ``root``, and its messages numbered there: a key is the query, the batch
    and the row. A replay finds the folder and sends what is in it. :func:`gridlake.sources.readers.once` drops what comes
    a second time, so that a topic with at-least-once delivery holds every message once for its readers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_key(batch, batch_id)
        folder = f"{root.rstrip('/')}/{name}"
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            number = F.monotonically_increasing_id().cast("string")
            rows = encode(batch).withColumn("key", F.concat(F.lit(f"{name}-"), number))
            rows.write.mode("overwrite").parquet(folder)
        publish(spark.read.parquet(folder), fmt, path, **options)
        if batch_id:
            discard(spark, f"{root.rstrip('/')}/{batch_key(batch, batch_id - 1)}")

    return write
