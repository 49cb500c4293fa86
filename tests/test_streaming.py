"""Streams run over several parts on one checkpoint and must equal the batch form."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions.payloads import parse_shares
from gridlake.operators import alerts, feed, forecast
from gridlake.sources import readers, sinks
from gridlake.streaming import alerts as stream_alerts
from gridlake.streaming import bronze, tables
from gridlake.streaming import feed as stream_feed
from gridlake.streaming import forecast as stream_forecast
from gridlake.streaming.runner import SERVICE, late_rows, start
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def land(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_bronze_stream_restarts_and_quarantines(spark, database, tmp_path):
    topic, table = tmp_path / "topic", f"{database}.bronze_dispatch"
    topic.mkdir()
    parts = [
        "2024-01-01 00:00:00,U1,10.5,Coal\nbad,U1,1,Coal\n",
        "2024-01-01 00:05:00,U2,1,Gas\n\n",
        "2024-01-02 00:00:00,U1,2,Solar\n",
    ]
    for number, text in enumerate(parts):
        (topic / f"{number}.txt").write_text(text)
        lines = readers.message_stream(spark, "text", str(topic))
        bronze.run_bronze(spark, lines, table, str(tmp_path / "checkpoint"), f"{database}.rejected")
    found = spark.table(table)
    assert found.columns == [f.name for f in schemas.BRONZE if f.name != "trading_date"] + ["trading_date"] or set(
        found.columns
    ) == {f.name for f in schemas.BRONZE}
    assert rows(found.select("unit_id", "generated_mw", F.col("trading_date").cast("string"))) == [
        ("U1", 10.5, "2024-01-01"),
        ("U1", 2.0, "2024-01-02"),
        ("U2", 1.0, "2024-01-01"),
    ]
    assert found.where("ingested_at IS NULL").count() == 0
    assert rows(spark.table(f"{database}.rejected").select("_corrupt_record")) == [("",), ("bad,U1,1,Coal",)]


def test_bronze_stream_without_quarantine_keeps_every_message(spark, database, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.txt").write_text("bad,U1,1,Coal\n2024-01-01 00:00:00,U1,10.5,Coal\n")
    table = f"{database}.bronze_dispatch"
    bronze.run_bronze(spark, readers.message_stream(spark, "text", str(topic)), table, str(tmp_path / "checkpoint"))
    assert rows(spark.table(table).select("unit_id", F.col("trading_date").cast("string"))) == [
        ("U1", "2024-01-01"),
        ("U1", None),
    ]


def test_bronze_service_keeps_running(spark, database, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    lines = readers.message_stream(spark, "text", str(topic))
    table = f"{database}.bronze_dispatch"
    running = bronze.run_bronze(
        spark, lines, table, str(tmp_path / "checkpoint"), trigger={"processingTime": "1 second"}
    )
    try:
        assert [q.isActive for q in running] == [True]
        (topic / "a.txt").write_text("2024-01-01 00:00:00,U1,10.5,Coal\n")
        running[0].processAllAvailable()
        assert spark.table(table).count() == 1
    finally:
        for q in running:
            q.stop()


def test_service_trigger_takes_what_is_there_at_once(spark, tmp_path):
    land(spark, tmp_path / "in", [("a", 1)], "k string, v int")
    stream = spark.readStream.schema("k string, v int").parquet(str(tmp_path / "in"))
    query = start(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"), SERVICE)
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "out")).count() == 1
    finally:
        query.stop()


def test_producer_counts_what_it_sends(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    documents = [
        'unit_id,fuel_type,generated_mw,trading_interval\n"a,b",Coal,0,2024-01-01 00:00:00\nU2,Gas,2,2024-01-01 00:05:00\n',
        'generated_mw,note,unit_id,trading_interval,fuel_type\n1,x,"a,b",2024-01-01 00:00:00,Coal\n2,x,U2,2024-01-01 00:05:00,Gas\n',
    ]
    for part, text in enumerate(documents):
        (landing / f"{part}.csv").write_text(text)
        picked = readers.landing_feed(spark, str(landing), schemas.DISPATCH_MESSAGE, streaming=True)
        lines = sinks.encode_csv(picked, [f.name for f in schemas.DISPATCH_MESSAGE], key="unit_id")
        query = stream_feed.publish_stream(lines, str(tmp_path / "checkpoint"), "text", str(tmp_path / "topic"))
        assert query.lastProgress["observedMetrics"]["published"]["sent"] == 2
    assert spark.read.text(str(tmp_path / "topic")).where("value LIKE '%\"a,b\"%'").count() == 2


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_dedupe(spark, tmp_path, salts):
    schema = "k string, ts timestamp, v int"
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for part in range(3):
        data = [(f"k{i % 5}", T0 + timedelta(minutes=i % 5), part * 100 + i) for i in range(50)]
        land(spark, folder, data, schema)
        stream = spark.readStream.schema(schema).parquet(str(folder))
        unique = tables.dedupe_stream(stream, ["k"], "ts", "1 hour", salts)
        start(unique.writeStream.format("parquet").option("path", out), str(tmp_path / "checkpoint"))
    found = spark.read.parquet(out)
    assert sorted(r.k for r in found.collect()) == [f"k{i}" for i in range(5)]
    assert found.agg(F.max("v")).first()[0] < 100


def test_changed_payloads_across_batches_and_replay(spark, tmp_path):
    schema = "feed string, n int, body string"
    folder = tmp_path / "in"
    data = [("x", i, body) for i, body in enumerate("AABBBAACAA")] + [("y", i, "A") for i in range(10)]
    parts = [[r for r in data if r[1] < 2], [r for r in data if 2 <= r[1] < 7], [r for r in data if r[1] >= 7]]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(str(folder))
        stream_feed.changed_payloads_stream(stream, ["feed"], "n", "body", 3, out, state, str(checkpoint))

    for part in parts:
        land(spark, folder, part, schema)
        run(tmp_path / "checkpoint")
    expected = rows(feed.changed_payloads(spark.createDataFrame(data, schema), ["feed"], "n", "body", 3))
    assert rows(spark.read.parquet(out).select("feed", "n", "body")) == expected

    # Without its commit record the last batch runs again, over the same files.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run(tmp_path / "checkpoint")
    assert rows(spark.read.parquet(out).select("feed", "n", "body")) == expected


def test_first_arrivals_have_no_time_limit(spark, database, tmp_path):
    schema = "k string, day date, at int, v int"
    folder, table = tmp_path / "in", f"{database}.first"
    parts = [
        [("a", T0.date(), 2, 2), ("a", T0.date(), 1, 1), ("b", T0.date(), 1, 1)],
        [("a", T0.date(), 0, 9), ("c", (T0 - timedelta(days=90)).date(), 5, 5)],
        [("c", (T0 - timedelta(days=90)).date(), 6, 6)],
    ]

    def run():
        stream = spark.readStream.schema(schema).parquet(str(folder))
        tables.first_arrivals_stream(stream, table, ["k"], ["at"], str(tmp_path / "checkpoint"), ["day"])

    for part in parts:
        land(spark, folder, part, schema)
        run()
    expected = [("a", 1), ("b", 1), ("c", 5)]
    assert rows(spark.table(table).select("k", "v")) == expected
    # A replayed batch replaces what it wrote.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table).select("k", "v")) == expected


def test_late_rows_are_counted(spark, tmp_path):
    schema = "k string, ts timestamp"
    for data in ([("a", T0)], [("b", T0 + timedelta(hours=9))], [("c", T0), ("d", T0)]):
        land(spark, tmp_path / "in", data, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        unique = tables.dedupe_stream(stream, ["k"], "ts", "1 hour", 1)
        query = start(unique.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    assert late_rows(query) == 2


def test_alerts_resolve_when_a_series_goes_silent(spark, tmp_path):
    schema = "ts timestamp, percent double, region string"
    rule = alerts.Rule("HighCoalPercentage", "warning", threshold=60.0, min_count=2)
    at = lambda i: T0 + timedelta(minutes=5 * i)
    parts = [
        [(at(0), 70.0, "n"), (at(1), 70.0, "n"), (at(0), 10.0, "s"), (at(1), 80.0, "s")],
        [(at(k), 10.0, "s") for k in range(2, 9)],
        [(at(9), 10.0, "s")],
    ]
    for part in parts:
        land(spark, tmp_path / "in", part, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        made = stream_alerts.alert_stream(stream, rule, "5 minutes", labels=["region"])
        start(made.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    found = spark.read.parquet(str(tmp_path / "out")).select("region", "state", "at", "started_at", "n")
    assert rows(found) == [("n", "firing", at(1), at(0), 2), ("n", "resolved", at(2), at(0), 2)]


def test_upsert_stream(spark, database, tmp_path):
    schema = "k string, day date, at int, v int"
    folder, table = tmp_path / "in", f"{database}.target"
    parts = [[("a", T0.date(), 1, 1), ("a", T0.date(), 2, 2), ("b", T0.date(), 1, 1)], [("a", T0.date(), 3, 3)]]
    for part in parts:
        land(spark, folder, part, schema)
        stream = spark.readStream.schema(schema).parquet(str(folder))
        tables.upsert_stream(stream, table, ["k"], ["at"], str(tmp_path / "checkpoint"), ["day"])
    assert rows(spark.table(table).select("k", "v")) == [("a", 3), ("b", 1)]


SHARE = "key string, ts timestamp, y double"


def shares():
    return [("a", T0 + timedelta(minutes=30 * i), (i * 37 % 11) / 11) for i in range(700)] + [
        ("b", T0 + timedelta(hours=7 * i), (i * 13 % 7) / 7) for i in range(60)
    ]


@pytest.mark.parametrize("model", ["linear", "additive"])
def test_forecast_stream_equals_the_backtest(spark, tmp_path, model):
    data = sorted(shares(), key=lambda r: r[1])
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for part in (data[:200], data[200:500], data[500:]):
        land(spark, folder, part[::-1] + part[:5], SHARE)
        stream = spark.readStream.schema(SHARE).parquet(str(folder))
        made = stream_forecast.forecast_stream(stream, ["key"], "ts", "y", horizon=2, model=model, emit="every")
        start(made.writeStream.format("parquet").option("path", out), str(tmp_path / "checkpoint"))
    df = spark.createDataFrame(data, SHARE)
    batch = forecast.MODELS[model](df, ["key"], "ts", "y", horizon=2, origins="all").collect()
    expected = {(r.key, r.origin_time, r.step): (r.n, r.event_time, r.yhat) for r in batch}
    found = spark.read.parquet(out).collect()
    assert {(r.key, r.origin_time, r.step) for r in found} == set(expected) and len(found) == len(expected)
    for r in found:
        n, event_time, yhat = expected[r.key, r.origin_time, r.step]
        assert (r.n, r.event_time) == (n, event_time) and r.yhat == pytest.approx(yhat, abs=1e-5)


def test_forecast_fans_out_to_topic_and_table(spark, database, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    checkpoint = str(tmp_path / "checkpoint")
    writers = {
        "topic": stream_forecast.topic_writer("text", str(tmp_path / "out")),
        "table": stream_forecast.table_writer(f"{database}.forecasts"),
    }
    for part in range(2):
        lines = [
            json.dumps({"event_time": str(T0 + timedelta(minutes=30 * (part * 3 + i))), "solar_share": 0.1 * i})
            for i in range(3)
        ]
        lines += ['{"event_time": "2024-01-01 09:00:00"}', "no json"]
        (topic / f"{part}.txt").write_text("\n".join(lines))
        received = parse_shares(
            readers.message_stream(spark, "text", str(topic)), schemas.SHARE_MESSAGE, "event_time", "solar_share"
        )
        stream_forecast.run_forecast(received, writers, checkpoint, model="linear", horizon=4)
    table = spark.table(f"{database}.forecasts")
    per_batch = table.groupBy("batch").agg(F.count("*").alias("rows"), F.max("n").alias("n"))
    assert rows(per_batch.select("rows", "n")) == [(4, 3), (4, 6)]
    sent = spark.read.text(str(tmp_path / "out")).collect()
    assert sorted(json.loads(r.value)["event_time"] for r in sent) == sorted(
        r.event_time.isoformat() for r in table.collect()
    )


def test_a_new_checkpoint_keeps_old_results_and_days_are_compacted(spark, database, tmp_path):
    table = f"{database}.forecasts"
    for run in range(2):
        land(spark, tmp_path / "in", [(T0 + timedelta(hours=run * 30 + i), 0.1 * i) for i in range(3)], "event_time timestamp, solar_share double")
        stream = spark.readStream.schema("event_time timestamp, solar_share double").parquet(str(tmp_path / "in"))
        writers = {"table": stream_forecast.table_writer(table)}
        stream_forecast.run_forecast(stream, writers, str(tmp_path / f"checkpoint-{run}"), model="linear", horizon=4)
    found = rows(spark.table(table).select("origin_time", "step"))
    assert len(found) == 8 and spark.table(table).select("batch").distinct().count() == 2
    stream_forecast.compact(spark, table, "2024-01-02")
    after = spark.table(table)
    assert rows(after.select("origin_time", "step")) == found
    assert rows(after.where("event_date < '2024-01-02'").select("batch").distinct()) == [("closed",)]
    assert after.where("event_date >= '2024-01-02' and batch = 'closed'").count() == 0


def test_unusable_shares_are_counted(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.txt").write_text('{"event_time": "2024-01-01 00:00:00", "solar_share": 0.5}\n{"event_time": "x"}\nno json\n')
    lines = readers.message_stream(spark, "text", str(topic))
    used = parse_shares(lines, schemas.SHARE_MESSAGE, "event_time", "solar_share", observed_as="shares")
    query = start(used.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "checkpoint"))
    counts = query.lastProgress["observedMetrics"]["shares"]
    assert (counts["received"], counts["unusable"]) == (3, 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_alert_stream(spark, tmp_path):
    schema = "ts timestamp, fuel string, mw double"
    percents = [70, 70, 70, 10, 70, 70, 70, 70, None, 70, 70, 70, 10, 10, 10]
    data = []
    for i, p in enumerate(percents):
        if p is not None:
            data += [(T0 + timedelta(minutes=5 * i), "Coal", float(p)), (T0 + timedelta(minutes=5 * i), "Gas", 100.0 - p)]
    rule = alerts.Rule("HighCoalPercentage", "warning", threshold=60.0, min_count=3)
    for part in (data[:5], data[5:14], data[14:]):
        land(spark, tmp_path / "in", part, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        metric, log = stream_alerts.run_alerts(
            spark, stream, rule, "5 minutes", str(tmp_path / "run"), "ts", "fuel", "coal", "mw", "5 minutes"
        )
    at = lambda i: T0 + timedelta(minutes=5 * i)
    found = sorted(tuple(r)[2:] for r in spark.read.parquet(log).collect())
    assert found == [
        ("firing", at(2), at(0), 3),
        ("firing", at(6), at(4), 3),
        ("firing", at(11), at(9), 3),
        ("resolved", at(3), at(0), 3),
        ("resolved", at(8), at(4), 4),
        ("resolved", at(12), at(9), 3),
    ]


def test_fan_out_to_one_writer_needs_no_checkpointed_copy(spark, tmp_path):
    land(spark, tmp_path / "in", [("a", 1)], "k string, v int")
    stream = spark.readStream.schema("k string, v int").parquet(str(tmp_path / "in"))
    writer = sinks.batch_folder(str(tmp_path / "out"))
    sinks.fan_out(stream, {"table": writer}, str(tmp_path / "checkpoint"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).drop("batch_id")) == [("a", 1)]
