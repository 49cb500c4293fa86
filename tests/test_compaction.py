"""Files of closed days are joined; a stop after any step is mended by the next run."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake.sources import readers
from gridlake.streaming import bronze, compaction
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def fill(spark, table, batches=4, days=3):
    """A table by day and batch: a small file for each."""
    data = [(b * 10 + d, float(b), (T0 + timedelta(days=d)).date(), f"b{b}") for b in range(batches) for d in range(days)]
    df = spark.createDataFrame(data, "id int, v double, day date, batch string").repartition(2)
    df.write.partitionBy("day", "batch").saveAsTable(table)
    return sorted((r[0], r[1], r[2]) for r in data)


def content(spark, table):
    spark.catalog.refreshTable(table)
    return sorted(tuple(r) for r in spark.table(table).select("id", "v", "day").collect())


def test_bins_hold_at_most_the_target():
    files = [compaction.File("d", f"f{i}", size) for i, size in enumerate([70, 60, 50, 40, 30, 20, 10, 100])]
    bins = compaction.packed(files, 100)
    assert sorted(f for b in bins for f in b) == sorted(files)
    assert all(sum(f.size for f in b) <= 100 for b in bins) and len(bins) == 4


def test_batches_of_closed_days_come_together(spark, database):
    table = f"{database}.t"
    before = fill(spark, table)
    compaction.compact(spark, table, "day", "2024-01-03", batch="batch")
    assert content(spark, table) == before
    found = spark.table(table)
    assert rows(found.where("day < '2024-01-03'").select("batch").distinct()) == [("closed",)]
    assert found.where("day = '2024-01-03'").select("batch").distinct().count() == 4
    assert compaction.file_sizes(found.where("day < '2024-01-03'")).count() == 2
    # Nothing is left to do, and late rows of a closed day join the others.
    files = rows(compaction.file_sizes(found))
    compaction.compact(spark, table, "day", "2024-01-03", batch="batch")
    spark.catalog.refreshTable(table)
    assert rows(compaction.file_sizes(spark.table(table))) == files
    spark.createDataFrame([(99, 9.0, T0.date(), "late")], "id int, v double, day date, batch string").write.insertInto(table)
    compaction.compact(spark, table, "day", "2024-01-03", batch="batch", since="2024-01-01")
    assert content(spark, table) == sorted([*before, (99, 9.0, T0.date())])
    assert compaction.file_sizes(spark.table(table).where("day < '2024-01-03'")).count() == 2


def test_large_files_move_without_being_written(spark, database):
    table = f"{database}.t"
    before = fill(spark, table)
    compaction.compact(spark, table, "day", "2024-01-03", batch="batch", target=10)
    assert content(spark, table) == before
    closed = spark.table(table).where("day < '2024-01-03'")
    assert rows(closed.select("batch").distinct()) == [("closed",)]
    assert compaction.file_sizes(closed).count() == 8


STEPS = ["staged", "planned", "added", "dropped", "swapped", "cleared"]


@pytest.mark.parametrize("stop", range(1, len(STEPS) + 1))
@pytest.mark.parametrize("target", [compaction.TARGET_BYTES, 10])
def test_a_stop_after_any_step_is_mended(spark, database, stop, target):
    table = f"{database}.t"
    before = fill(spark, table)
    run = compaction.steps(spark, table, "day", "2024-01-03", "batch", target=target)
    assert [next(run) for _ in range(stop)] == STEPS[:stop]
    run.close()
    compaction.compact(spark, table, "day", "2024-01-03", batch="batch", target=target)
    assert content(spark, table) == before
    assert rows(spark.table(table).where("day < '2024-01-03'").select("batch").distinct()) == [("closed",)]


def test_bronze_is_compacted_within_its_dates(spark, database, tmp_path):
    topic, table = tmp_path / "topic", f"{database}.bronze_dispatch"
    topic.mkdir()
    for part in range(5):
        (topic / f"{part}.txt").write_text(
            f"2024-01-01 00:0{part}:00,U{part},1,Coal\n2024-01-02 00:0{part}:00,U{part},1,Coal\n"
        )
        bronze.run_bronze(spark, readers.message_stream(spark, "text", str(topic)), table, str(tmp_path / "checkpoint"))
    before = rows(spark.table(table).select("unit_id", "trading_interval", "arrival.offset"))
    run = compaction.steps(spark, table, "trading_date", "2024-01-02")
    assert [next(run) for _ in range(3)] == STEPS[:3]
    run.close()
    bronze.compact(spark, table, "2024-01-02")
    spark.catalog.refreshTable(table)
    found = spark.table(table)
    assert rows(found.select("unit_id", "trading_interval", "arrival.offset")) == before and len(before) == 10
    assert compaction.file_sizes(found.where("trading_date = '2024-01-01'")).count() == 1
    assert compaction.file_sizes(found.where("trading_date = '2024-01-02'")).count() == 5
    # The stream goes on.
    (topic / "9.txt").write_text("2024-01-01 09:00:00,U9,1,Coal\n")
    bronze.run_bronze(spark, readers.message_stream(spark, "text", str(topic)), table, str(tmp_path / "checkpoint"))
    assert spark.table(table).where(F.col("unit_id") == "U9").count() == 1
