"""Upserts of keys that move between partitions touch the old and the new partition only."""

from __future__ import annotations

import random

import pytest

from gridlake.operators import gold, keyindex
from tests.conftest import rows

SCHEMA = "k int, day string, v int"
OPTIONS = {"keys": ["k"], "partition_by": ["day"], "key_moves": True}


def files(spark, table):
    spark.catalog.refreshTable(table)
    found = spark.table(table).select("day", "_metadata.file_path").distinct().collect()
    return {day: {r[1] for r in found if r[0] == day} for day in {r[0] for r in found}}


def test_only_the_old_and_the_new_partition_are_written(spark, database):
    table = f"{database}.t"
    first = spark.createDataFrame([(k, f"d{k % 4}", 0) for k in range(40)], SCHEMA)
    assert gold.upsert_table(spark, table, first, **OPTIONS) is None
    before = files(spark, table)
    # Key 1 moves from d1 to d3, key 3 stays in d3, key 50 is new.
    batch = spark.createDataFrame([(1, "d3", 9), (3, "d3", 9), (50, "d5", 9)], SCHEMA)
    assert gold.upsert_table(spark, table, batch, **OPTIONS) == ["d1", "d3", "d5"]
    after = files(spark, table)
    assert after["d0"] == before["d0"] and after["d2"] == before["d2"]
    assert after["d1"] != before["d1"] and after["d3"] != before["d3"]
    want = {k: (f"d{k % 4}", 0) for k in range(40)} | {1: ("d3", 9), 3: ("d3", 9), 50: ("d5", 9)}
    assert rows(spark.table(table).select("k", "day", "v")) == sorted(((k, *x) for k, x in want.items()), key=repr)
    # A replay changes nothing.
    gold.upsert_table(spark, table, batch, **OPTIONS)
    assert spark.table(table).count() == 41


def test_an_emptied_partition_goes(spark, database):
    table = f"{database}.t"
    gold.upsert_table(spark, table, spark.createDataFrame([(1, "d1", 0), (2, "d2", 0)], SCHEMA), **OPTIONS)
    gold.upsert_table(spark, table, spark.createDataFrame([(1, "d2", 5)], SCHEMA), **OPTIONS)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("k", "day", "v")) == [(1, "d2", 5), (2, "d2", 0)]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["day=d2"]


def test_an_emptied_partition_below_another_goes(spark, database):
    table, schema = f"{database}.t", "k int, day string, hour string, v int"
    options = {"keys": ["k"], "partition_by": ["day", "hour"], "key_moves": True}
    first = [(1, "d1", "h1", 0), (2, "d1", "h2", 0), (3, "d2", "h1", 0)]
    gold.upsert_table(spark, table, spark.createDataFrame(first, schema), **options)
    assert gold.upsert_table(spark, table, spark.createDataFrame([(1, "d1", "h2", 5)], schema), **options) == ["d1"]
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("k", "day", "hour", "v")) == [(1, "d1", "h2", 5), (2, "d1", "h2", 0), (3, "d2", "h1", 0)]
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 2


def test_many_moves_against_a_dictionary(spark, database, monkeypatch):
    monkeypatch.setattr(keyindex, "BUCKET_KEYS", 10)
    rng, table, want = random.Random(6), f"{database}.t", {}
    for turn in range(6):
        batch = {rng.randrange(60): (f"d{rng.randrange(7)}", turn) for _ in range(20)}
        want |= batch
        gold.upsert_table(spark, table, spark.createDataFrame([(k, *x) for k, x in batch.items()], SCHEMA), **OPTIONS)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("k", "day", "v")) == sorted(((k, *x) for k, x in want.items()), key=repr)
    index = spark.table(keyindex.index_name(table))
    assert rows(index.select("k", "day")) == sorted(((k, x[0]) for k, x in want.items()), key=repr)
    assert index.select(keyindex.BUCKET).distinct().count() > 1


@pytest.mark.parametrize("replayed", [True, False])
@pytest.mark.parametrize("step", ["overwrite_table", "settle"])
def test_a_stop_half_way_is_mended(spark, database, monkeypatch, step, replayed):
    table = f"{database}.t"
    gold.upsert_table(spark, table, spark.createDataFrame([(1, "d1", 0), (2, "d2", 0), (3, "d1", 0)], SCHEMA), **OPTIONS)
    batch = spark.createDataFrame([(1, "d2", 5), (3, "d3", 5)], SCHEMA)
    gold.upsert_table(spark, table, spark.createDataFrame([(2, "d2", 1)], SCHEMA), **OPTIONS)

    def stop(*arguments, **options):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(keyindex if step == "settle" else gold, step, stop)
        with pytest.raises(RuntimeError):
            gold.upsert_table(spark, table, batch, **OPTIONS)
    if replayed:
        gold.upsert_table(spark, table, batch, **OPTIONS)
    # A later move of the same keys still finds where they are, or may be; an upsert of other keys forgets nothing.
    gold.upsert_table(spark, table, spark.createDataFrame([(2, "d2", 1)], SCHEMA), **OPTIONS)
    gold.upsert_table(spark, table, spark.createDataFrame([(1, "d4", 7), (3, "d1", 7)], SCHEMA), **OPTIONS)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("k", "day", "v")) == [(1, "d4", 7), (2, "d2", 1), (3, "d1", 7)]


def test_rivals_are_found_in_other_partitions(spark, database):
    table = f"{database}.t"
    gold.upsert_table(spark, table, spark.createDataFrame([(k, f"d{k}", 0) for k in range(6)], SCHEMA), **OPTIONS)
    gold.upsert_table(spark, table, spark.createDataFrame([(2, "d2", 1)], SCHEMA), **OPTIONS)
    # A row that came by another way than the upsert.
    spark.createDataFrame([(4, 7, "d2")], "k int, v int, day string").write.insertInto(table)
    found = keyindex.rivals(spark, table, ["k"], "day", ["d2"])
    assert rows(found.select("k", "day")) == [(2, "d2"), (4, "d2"), (4, "d4")]
    held = {p.split("day=")[1].split("/")[0] for p in found.inputFiles() if "day=" in p}
    assert held <= {"d2", "d4"}
