"""Message stream into the date-partitioned bronze table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.operators.bronze import derive_columns, is_quarantined, parse_messages
from gridlake.schemas import ARRIVAL, BRONZE, DISPATCH_MESSAGE
from gridlake.session import discard
from gridlake.sources.readers import arrived
from gridlake.sources.sinks import batch_key, ensure_table
from gridlake.streaming import compaction
from gridlake.streaming.runner import start


def run_bronze(
    spark: SparkSession,
    lines: DataFrame,
    table: str,
    checkpoint: str,
    quarantine_table: str | None = None,
    schema: T.StructType = DISPATCH_MESSAGE,
    trigger: Mapping[str, object] | None = None,
    fmt: str = "parquet",
) -> list[StreamingQuery]:
    """Append parsed messages to ``table``, each exactly once per checkpoint.

    With ``quarantine_table`` messages that do not parse go there instead, from the same batch: the topic is read and parsed
    once. With a service trigger the returned stream is still running.

    The parsed batch is kept next to the checkpoint until the one after it is done. A batch that runs again finds it there,
    so that its rows have the times and arrivals they had, and appends only those that the table does not hold yet.
    """
    ensure_table(spark, table, BRONZE, ["trading_date"], fmt)
    like = _parsed(spark.createDataFrame([], lines.schema), schema, "")
    if quarantine_table:
        ensure_table(spark, quarantine_table, like.drop("ingested_at", "trading_date").schema, (), fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{checkpoint.rstrip('/')}-batch/{batch_key(batch, batch_id)}"
        if not _exists(spark, f"{folder}/rows/_SUCCESS"):
            rows = _parsed(batch, schema, batch_key(batch, batch_id))
            rows.write.mode("overwrite").parquet(f"{folder}/rows")
        rows = spark.read.schema(like.schema).parquet(f"{folder}/rows")
        good = rows.where(~is_quarantined()) if quarantine_table else rows
        _append_once(good, table, f"{folder}/begun", ["trading_date"])
        if quarantine_table:
            _append_once(rows.where(is_quarantined()), quarantine_table, f"{folder}/begun-quarantine")
        if batch_id:
            discard(spark, f"{checkpoint.rstrip('/')}-batch/{batch_key(batch, batch_id - 1)}")

    running = start(lines.writeStream.foreachBatch(write), checkpoint, trigger)
    for name in filter(None, (table, quarantine_table)):
        # Batches are written by a session of the stream's own, whose new files this one has yet to see.
        spark.catalog.refreshTable(name)
    return [running]


def _parsed(lines: DataFrame, schema: T.StructType, batch: str) -> DataFrame:
    rows = arrived(lines)
    if "arrival" not in rows.columns:
        # A message that does not say how it arrived has its place in its batch.
        place = F.struct(
            F.lit(None).cast("timestamp").alias("time"),
            F.lit(batch).alias("source"),
            F.monotonically_increasing_id().alias("offset"),
        )
        rows = rows.withColumn("arrival", place.cast(ARRIVAL))
    return derive_columns(parse_messages(rows, schema))


def _append_once(rows: DataFrame, table: str, mark: str, partition_by: Sequence[str] = ()) -> None:
    """Append, and where an earlier try may have appended already, only what is missing: no two rows arrive alike."""
    spark = rows.sparkSession
    target = spark.table(table)
    if _exists(spark, mark):
        known = target
        if "ingested_at" in target.columns:
            # One time per batch, which the files' statistics know.
            known = known.where(F.col("ingested_at").isin([r[0] for r in rows.select("ingested_at").distinct().collect()]))
        same = F.col("__new.arrival").eqNullSafe(F.col("__known.arrival"))
        rows = rows.alias("__new").join(known.select("arrival").alias("__known"), same, "left_anti")
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path(mark)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()
    columns = rows.select(*target.columns)
    spread = columns.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else columns
    spread.write.mode("append").insertInto(table)


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found))


def compact(spark: SparkSession, table: str, before: str, **options: object) -> None:
    """Join the small files that every batch leaves in the days before the date ``before``.

    Run it while no stream writes to those days; :mod:`gridlake.streaming.compaction` says what a stop leaves behind.
    """
    compaction.compact(spark, table, "trading_date", before, **options)
