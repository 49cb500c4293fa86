"""Late rows are kept in a table of their own, across restarts and replays."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridlake.sources import sinks
from gridlake.streaming import late, tables
from gridlake.streaming.runner import start
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp"


def hour(h):
    return T0 + timedelta(hours=h)


PARTS = [
    [("a", hour(0)), ("b", hour(5)), ("c", None)],
    [("d", hour(3)), ("e", hour(4)), ("f", hour(9)), ("g", hour(2))],
    [("h", hour(8)), ("i", hour(6)), ("j", hour(7)), ("k", None)],
    [("l", hour(7.5)), ("m", hour(7.4))],
]
LATE = ["d", "g", "i", "j", "m"]


def run(spark, tmp_path):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    return late.split_late(
        stream,
        "ts",
        "90 minutes",
        sinks.batch_folder(str(tmp_path / "on-time")),
        sinks.batch_folder(str(tmp_path / "late")),
        str(tmp_path / "marks"),
        str(tmp_path / "checkpoint"),
    )


def found(spark, tmp_path, name):
    return sorted(r.k for r in spark.read.parquet(str(tmp_path / name)).collect())


def test_late_rows_are_kept_across_restarts_and_replays(spark, tmp_path):
    for part in PARTS:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark, tmp_path)
    everything = sorted(r[0] for part in PARTS for r in part)
    assert found(spark, tmp_path, "late") == LATE
    assert found(spark, tmp_path, "on-time") == sorted(set(everything) - set(LATE))
    assert len([p for p in (tmp_path / "marks").iterdir()]) == 2
    # Without its commit record the last batch runs again.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run(spark, tmp_path)
    assert found(spark, tmp_path, "late") == LATE and len(found(spark, tmp_path, "on-time")) == len(everything) - len(LATE)


def test_a_watermark_drops_nothing_that_came_on_time(spark, tmp_path):
    for part in PARTS:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run(spark, tmp_path)
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(str(tmp_path / "on-time"))
        unique = tables.dedupe_stream(stream.where("ts IS NOT NULL"), ["k"], "ts", "90 minutes", 1)
        start(unique.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    assert found(spark, tmp_path, "out") == ["a", "b", "e", "f", "h"]


def test_dropped_rows_add_up_across_restarts(spark, tmp_path):
    listener = late.DroppedRows(spark, str(tmp_path / "dropped"))
    spark.streams.addListener(listener)
    try:
        for data in ([("a", hour(0))], [("b", hour(9))], [("c", hour(0)), ("d", hour(1))], [("e", hour(20)), ("f", hour(2))]):
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
            unique = tables.dedupe_stream(stream, ["k"], "ts", "1 hour", 1)
            query = start(unique.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
            listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    counted = late.dropped_rows(spark, str(tmp_path / "dropped"))
    assert rows(counted.groupBy("query").agg(F.sum("dropped")).select("sum(dropped)")) == [(3,)]
    assert counted.select("batch").distinct().count() == counted.count()
