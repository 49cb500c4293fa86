from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridlake.operators import alerts, quality
from gridlake.plans import daily
from tests.conftest import plan, rows

T0 = datetime(2024, 1, 1)
UNITS = "unit_id,fuel_type,station_name,region_id,trading_date\n{}"
REGIONS = "region_id,region_name,trading_date\nNSW1,New South Wales,2024-01-01\nQLD1,Queensland,2024-01-01\n"


@pytest.fixture
def chain(database, tmp_path):
    (tmp_path / "topic").mkdir()
    (tmp_path / "regions.csv").write_text(REGIONS)
    (tmp_path / "units.csv").write_text(
        UNITS.format("UNIT1,Coal,StationA,NSW1,2024-01-01\nUNIT2,Solar,StationB,QLD1,2024-01-01\n")
    )
    options = {
        "database": database,
        "unit_csv": str(tmp_path / "units.csv"),
        "region_csv": str(tmp_path / "regions.csv"),
        "checkpoint": str(tmp_path / "checkpoint"),
        "source": {"fmt": "text", "path": str(tmp_path / "topic")},
        "target": {"fmt": "text", "path": str(tmp_path / "shares"), "mode": "append"},
    }
    return lambda **extra: daily.Chain(**{**options, **extra})


def send(tmp_path, name, *lines):
    (tmp_path / "topic" / name).write_text("\n".join(lines) + "\n")


def test_two_runs(spark, chain, tmp_path):
    first = chain(run_id="r1")
    send(
        tmp_path,
        "a.txt",
        "2024-01-01 00:00:00,UNIT1,100,Coal",
        "2024-01-01 00:05:00,UNIT2,50,Solar",
        "trading_interval,unit_id,generated_mw,fuel_type",
    )
    log = daily.run(spark, first)
    assert log.count() == 8 and log.where("status = 0").count() == 0
    fact = spark.table(first.table("fact_dispatch"))
    assert rows(fact.select("unit_id", "generated_mw")) == [("UNIT1", 100.0), ("UNIT2", 50.0)]
    assert spark.table(first.table("bronze_rejected")).count() == 1
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "shares")).collect()]
    assert sorted(m.get("solar_share", -1) for m in sent) == [-1, 1.0]

    # A correction of a known key, a new date, and a renamed unit with a later snapshot date.
    (tmp_path / "units.csv").write_text(
        UNITS.format("UNIT1,Coal,StationA,NSW1,2024-01-01\nUNIT2,Solar,StationC,NSW1,2024-01-02\n")
    )
    send(tmp_path, "b.txt", "2024-01-01 00:05:00,UNIT2,60,Solar", "2024-01-02 00:00:00,UNIT1,70,Coal")
    second = chain(run_id="r2")
    daily.run(spark, second)
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "shares")).collect()]
    # The share of 00:05 is still 1, so only the new interval was sent.
    assert len(sent) == 3 and sum(m["event_time"].startswith("2024-01-02") for m in sent) == 1
    spark.catalog.refreshTable(first.table("fact_dispatch"))
    fact = spark.table(first.table("fact_dispatch"))
    assert rows(fact.select("unit_id", "generated_mw")) == [("UNIT1", 100.0), ("UNIT1", 70.0), ("UNIT2", 60.0)]
    dim = spark.table(first.table("dim_unit"))
    assert rows(dim.select("unit_id", "unit_name", "region_id")) == [
        ("UNIT1", "StationA", "NSW1"),
        ("UNIT2", "StationC", "NSW1"),
    ]
    assert spark.table(first.table("validations")).select("run_id").distinct().count() == 4


def test_a_failed_gate_stops_the_run_and_raises_an_alert(spark, chain, tmp_path):
    send(tmp_path, "a.txt", "2024-01-01 00:00:00,UNIT1,-5,Coal", "2024-01-01 00:00:00,UNIT1,-5,Coal")
    run = chain()
    with pytest.raises(quality.QualityError, match="bronze_suite"):
        daily.run(spark, run)
    assert not spark.catalog.tableExists(run.table("silver_dispatch_clean"))
    log = spark.table(run.table("run_log"))
    assert rows(log.select("stage", "status")) == [("bronze", 1), ("bronze_gate", 0), ("metadata", 1)]
    rule = alerts.Rule("PipelineFailure", "critical", threshold=0.0)
    found = alerts.status_alert(log, ["stage"], "finished_at", "status", "1 day", rule)
    assert [r.stage for r in found.collect()] == ["bronze_gate"]
    assert alerts.slow_runs(log, "started_at", "finished_at").count() == 0


def test_a_lower_correction_in_one_batch_wins(spark, chain, tmp_path):
    run = chain()
    send(tmp_path, "a.txt", "2024-01-01 00:00:00,UNIT1,100,Coal", "2024-01-01 00:00:00,UNIT1,60,Coal")
    daily.load_metadata(spark, run)
    daily.load_bronze(spark, run)
    daily.build_silver(spark, run, daily.find_news(spark, run))
    assert rows(spark.table(run.table("silver_dispatch_clean")).select("generated_mw")) == [(60.0,)]


def test_a_run_reads_and_rewrites_only_the_dates_it_touches(spark, chain, tmp_path):
    run = chain()
    send(
        tmp_path,
        "a.txt",
        "2024-01-01 00:00:00,UNIT1,1,Coal",
        "2024-01-02 00:00:00,UNIT1,2,Coal",
        "2024-01-03 00:00:00,UNIT1,3,Coal",
    )
    daily.run(spark, run)
    files = lambda d: {r[0] for r in spark.table(run.table("silver_dispatch_clean")).where(f"trading_date = '{d}'").select("_metadata.file_path").collect()}  # noqa: E731,E501
    before = {d: files(d) for d in ("2024-01-01", "2024-01-02")}
    send(tmp_path, "b.txt", "2024-01-02 00:00:00,UNIT1,5,Coal")
    daily.run(spark, run)
    spark.catalog.refreshTable(run.table("silver_dispatch_clean"))
    assert files("2024-01-01") == before["2024-01-01"] and files("2024-01-02") != before["2024-01-02"]
    assert rows(spark.table(run.table("fact_dispatch")).select("generated_mw")) == [(1.0,), (3.0,), (5.0,)]
    news = daily.find_news(spark, run)
    assert news.dates == [] and news.upto is None
    assert [str(d) for d in daily.find_news(spark, run, "2024-01-02").dates] == ["2024-01-02", "2024-01-03"]
    dates = daily.News(None, None, [T0.date()])
    scan = next(x for x in plan(daily.on_dates(spark.table(run.table("bronze_dispatch")), dates)).splitlines() if "FileScan" in x)
    assert "trading_date" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    later = daily.new_rows(spark, run, T0)
    scan = next(line for line in plan(later).splitlines() if "FileScan" in line)
    assert "ingested_at" in scan.split("PushedFilters: [")[1]


def test_a_run_without_news_publishes_nothing(spark, chain, tmp_path):
    send(tmp_path, "a.txt", "2024-01-01 00:00:00,UNIT2,1,Solar")
    for _ in range(2):
        daily.run(spark, chain())
    assert spark.read.text(str(tmp_path / "shares")).count() == 1


def test_model_tests_read_what_a_run_wrote(spark, chain, tmp_path):
    units = "".join(f"UNIT{i},Coal,Station{i},NSW1,2024-01-0{1 + i % 5}\n" for i in range(10))
    (tmp_path / "units.csv").write_text(UNITS.format(units))
    send(tmp_path, "a.txt", *[f"2024-01-0{d} 00:00:00,UNIT{d},{d},Coal" for d in range(1, 6)])
    run = chain()
    daily.run(spark, run)
    # The next snapshot moves UNIT1 from the 2nd to the 5th, and a reading of the 3rd is corrected.
    (tmp_path / "units.csv").write_text(UNITS.format("UNIT1,Coal,Station1,NSW1,2024-01-05\nUNIT4,Coal,Station4,NSW1,2024-01-05\n"))
    send(tmp_path, "b.txt", "2024-01-03 00:00:00,UNIT3,30,Coal")
    seen = {}
    original = daily.check_models
    try:
        daily.check_models = lambda spark, chain, written: (seen.update(written), original(spark, chain, written))
        daily.run(spark, run)
    finally:
        daily.check_models = original
    assert {k: sorted(map(str, v)) for k, v in seen.items()} == {
        "fact_dispatch": ["2024-01-03"],
        "dim_unit": ["2024-01-02", "2024-01-05"],
        "dim_region": ["2024-01-01"],
    }
    for model in daily.MODELS:
        found = daily.model_results(spark, run.table(model), model, seen[model])
        dates = {p.split("trading_date=")[1].split("/")[0] for p in found.inputFiles() if "trading_date=" in p}
        assert dates <= {str(d) for d in seen[model]} and all(r["passed"] for r in found.collect())
        scans = [x for x in plan(found).splitlines() if "FileScan" in x]
        assert scans and all("trading_date" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in scans)
    # A key that came to a written date by another way is found in the date that holds it too.
    twice = spark.table(run.table("dim_unit")).where("unit_id = 'UNIT2'").withColumn("trading_date", F.lit("2024-01-05").cast("date"))
    twice.write.insertInto(run.table("dim_unit"))
    spark.catalog.refreshTable(run.table("dim_unit"))
    failed = [tuple(r) for r in daily.model_results(spark, run.table("dim_unit"), "dim_unit", seen["dim_unit"]).collect() if not r["passed"]]
    assert failed == [("dim_unit", "unit_id", "unique", 1, False)]
    with pytest.raises(quality.QualityError, match="dim_unit.unit_id unique: 1"):
        daily.check_models(spark, run, seen)
