from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridlake.operators import gold
from gridlake.sources import sinks
from tests.conftest import plan, rows

SCHEMA = "unit_id string, trading_date date, unit_name string"


def day(number: int) -> date:
    return date(2024, 1, number)


def dim(spark, *data):
    return spark.createDataFrame([(k, day(d), n) for k, d, n in data], SCHEMA)


def test_slice_starts_at_the_newest_target_value(spark):
    source = dim(spark, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x"))
    target = dim(spark, ("a", 1, "x"), ("b", 2, "x"))
    assert [r.unit_id for r in gold.incremental_slice(source, target, "trading_date").collect()] == ["b", "c"]
    assert gold.incremental_slice(source, None, "trading_date").count() == 3
    assert gold.incremental_slice(source, target.limit(0), "trading_date").count() == 3
    assert gold.incremental_slice(source, target, "trading_date", "1 day").count() == 3
    assert [r.unit_id for r in gold.late_rows(source, target, "trading_date").collect()] == ["a"]


def test_null_rows_pass_the_first_load_only(spark):
    source = spark.createDataFrame([("a", None, "x"), ("b", day(5), "x")], SCHEMA)
    target = dim(spark, ("z", 1, "x"))
    assert gold.incremental_slice(source, None, "trading_date").count() == 2
    assert rows(gold.incremental_slice(source, target, "trading_date")) == [("b", day(5), "x")]
    assert rows(gold.late_rows(source, target, "trading_date")) == [("a", None, "x")]


def test_slice_prunes_partitions(spark, database):
    fact = f"{database}.fact"
    data = [(datetime(2024, 1, d), d) for d in range(1, 6)]
    df = spark.createDataFrame(data, "ts timestamp, v int").withColumn("day", F.to_date("ts"))
    sinks.replace_table(df, fact, ["day"])
    sliced = gold.incremental_slice(
        spark.table(fact), spark.table(fact).where("v <= 3"), "ts", date_column="day"
    )
    assert sorted(r.v for r in sliced.collect()) == [3, 4, 5]
    scan = next(line for line in plan(sliced).splitlines() if "FileScan" in line)
    assert "day" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_upsert_is_idempotent(spark):
    target = dim(spark, ("a", 1, "x"), ("b", 1, "x"))
    batch = dim(spark, ("b", 2, "y"), ("c", 2, "y"))
    once = gold.upsert(target, batch, ["unit_id"])
    assert rows(once) == [("a", day(1), "x"), ("b", day(2), "y"), ("c", day(2), "y")]
    assert rows(gold.upsert(once, batch, ["unit_id"])) == rows(once)


def test_repeated_and_null_keys(spark):
    target = dim(spark, ("a", 1, "x"))
    twice = dim(spark, ("b", 2, "y"), ("b", 3, "z"))
    with pytest.raises(Exception, match="repeated upsert key"):
        gold.upsert(target, twice, ["unit_id"]).collect()
    latest = gold.upsert(target, twice, ["unit_id"], "latest", ["trading_date"])
    assert ("b", day(3), "z") in rows(latest)
    with pytest.raises(Exception, match="NULL in upsert key"):
        gold.upsert(target, dim(spark, (None, 1, "x")), ["unit_id"]).collect()
    with pytest.raises(Exception, match="NULL in upsert key"):
        gold.upsert(target, dim(spark, (None, 1, "x")), ["unit_id"], "latest", ["trading_date"]).collect()


def test_dim_key_that_moves_to_another_date_leaves_no_copy(spark, database):
    table = f"{database}.dim_unit"
    options = {"keys": ["unit_id"], "column": "trading_date", "partition_by": ["trading_date"], "key_moves": True}
    gold.build_incremental(spark, dim(spark, ("a", 1, "x"), ("b", 1, "x")), table, **options)
    gold.build_incremental(spark, dim(spark, ("a", 2, "y")), table, **options)
    assert rows(spark.table(table).select("unit_id", "trading_date", "unit_name")) == [
        ("a", day(2), "y"),
        ("b", day(1), "x"),
    ]


def test_fact_upsert_rewrites_only_the_dates_it_names(spark, database):
    table = f"{database}.fact"
    first = dim(spark, ("a", 1, "x"), ("b", 1, "x"), ("c", 2, "x"))
    keys, parts = ["unit_id", "trading_date"], ["trading_date"]
    gold.upsert_table(spark, table, first, keys, parts)
    files = {r[0] for r in spark.table(table).where("trading_date = '2024-01-01'").select("_metadata.file_path").collect()}
    gold.upsert_table(spark, table, dim(spark, ("c", 2, "y"), ("d", 3, "y")), keys, parts)
    gold.upsert_table(spark, table, dim(spark, ("c", 2, "y"), ("d", 3, "y")), keys, parts)
    found = rows(spark.table(table).select("unit_id", "trading_date", "unit_name"))
    assert found == [("a", day(1), "x"), ("b", day(1), "x"), ("c", day(2), "y"), ("d", day(3), "y")]
    after = {r[0] for r in spark.table(table).where("trading_date = '2024-01-01'").select("_metadata.file_path").collect()}
    assert files == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_upsert_reads_only_the_dates_it_names(spark, database):
    table = f"{database}.fact"
    data = dim(spark, *[(f"u{d}", d, "x") for d in range(1, 9)])
    gold.upsert_table(spark, table, data, ["unit_id"], ["trading_date"])
    batch = dim(spark, ("u3", 3, "y"), ("u5", 5, "y"))
    near = gold.touched(spark.table(table), batch, ["trading_date"])
    assert sorted(r.unit_id for r in near.collect()) == ["u3", "u5"]
    scan = next(line for line in plan(near).splitlines() if "FileScan" in line and "fact" in line)
    assert "trading_date" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    gold.upsert_table(spark, table, batch, ["unit_id"], ["trading_date"])
    names = {r.unit_id: r.unit_name for r in spark.table(table).collect()}
    assert names == {f"u{d}": "y" if d in (3, 5) else "x" for d in range(1, 9)}
    with pytest.raises(Exception, match="NULL in upsert key"):
        gold.upsert_table(
            spark, table, spark.createDataFrame([("u1", None, "x")], SCHEMA), ["unit_id"], ["trading_date"]
        )


def test_the_bound_comes_from_the_partition_list(spark, database):
    table = f"{database}.fact"
    gold.upsert_table(spark, table, dim(spark, ("a", 1, "x"), ("b", 7, "x")), ["unit_id"], ["trading_date"])
    newest = gold.newest_partition(spark, table, "trading_date")
    assert newest.first()[0] == day(7) and "FileScan" not in plan(newest)
    source = dim(spark, ("a", 1, "y"), ("b", 7, "y"), ("c", 9, "y"))
    sliced = gold.incremental_slice(source, spark.table(table), "trading_date", None, "trading_date", newest)
    assert sorted(r.unit_id for r in sliced.collect()) == ["b", "c"]


def test_upserts_leave_no_staged_copies(spark, database, monkeypatch, tmp_path):
    monkeypatch.setattr(gold, "scratch_dir", lambda spark, purpose: str(tmp_path / f"{purpose}-{len(calls)}-{calls.append(0)}"))
    calls: list[int] = []
    for moves in (False, True):
        for version in "xyz":
            batch = dim(spark, ("a", 1, version))
            gold.upsert_table(spark, f"{database}.t{moves}", batch, ["unit_id"], ["trading_date"], key_moves=moves)
    assert len(calls) == 10 and not list(tmp_path.iterdir())


def test_a_repeated_dimension_key_fails_the_star(spark):
    fact = spark.createDataFrame([("u1", "Coal", 1.0)], "unit_id string, fuel_type string, generated_mw double")
    units = spark.createDataFrame([("u1", "One", "r1")], "unit_id string, unit_name string, region_id string")
    regions = spark.createDataFrame([("r1", "North"), ("r1", "South")], "region_id string, region_name string")
    with pytest.raises(Exception, match="repeated lookup key"):
        gold.star(fact, units, regions).collect()


def test_star_does_not_multiply_rows(spark):
    fact = spark.createDataFrame(
        [("u1", "Coal", 1.0), ("u1", "Coal", 2.0), ("u9", "Gas", 4.0)], "unit_id string, fuel_type string, generated_mw double"
    )
    units = spark.createDataFrame([("u1", "One", "r1"), ("u2", "Two", "r9")], "unit_id string, unit_name string, region_id string")
    regions = spark.createDataFrame([("r1", "North")], "region_id string, region_name string")
    assert gold.star(fact, units, regions).count() == 3
    assert rows(gold.star_generation(fact, units, regions)) == [("North", "Coal", 3.0, 2), (None, "Gas", 4.0, 1)]
