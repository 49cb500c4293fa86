"""Streams with timers, joined streams, the outbox, and landed files that split."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import alerts, forecast, metrics
from gridlake.sources import readers, sinks
from gridlake.streaming import alerts as stream_alerts
from gridlake.streaming import feed as stream_feed
from gridlake.streaming import forecast as stream_forecast
from gridlake.streaming import rates
from gridlake.streaming.runner import start
from tests.conftest import plan, rows

T0 = datetime(2024, 1, 1)


def land(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))


def minutes(n):
    return T0 + timedelta(minutes=n)


SAMPLE = "source string, ts timestamp, value double"


def samples():
    rng = random.Random(2)
    data = []
    for source in ("coal", "gas"):
        value, at = 0.0, 0.0
        for _ in range(150):
            at += rng.choice([0.2, 0.5, 1, 1, 3, 9])
            value = value + rng.randint(0, 9) if rng.random() > 0.06 else rng.randint(0, 3)
            data.append((source, minutes(at), float(value)))
    return [*data, ("gas", minutes(9), float("nan")), ("gas", minutes(9), None), ("coal", data[9][1], data[9][2] - 5)]


def test_rates_of_a_stream_equal_those_at_rest(spark, tmp_path):
    data = sorted(samples(), key=lambda r: r[1])
    late = [r for i, r in enumerate(data) if i % 9 == 4]
    rest = [r for i, r in enumerate(data) if i % 9 != 4]
    for part in range(4):
        # Every ninth sample comes a little late, within the delay.
        low, high = minutes(part * 90), minutes(part * 90 + 90)
        chosen = [r for r in rest if low <= r[1] < high]
        chosen += [r for r in late if low <= r[1] + timedelta(minutes=10) and (part == 3 or r[1] + timedelta(minutes=10) < high)]
        if part == 3:
            chosen += [r for r in rest if r[1] >= high] + [(None, minutes(5000), None)]
        land(spark, tmp_path / "in", chosen, SAMPLE)
        stream = spark.readStream.schema(SAMPLE).parquet(str(tmp_path / "in"))
        found = rates.rate_stream(stream, ["source"], "ts", "value", "5 minutes", "1 minute", "10 minutes")
        start(found.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    df = spark.createDataFrame(data, SAMPLE)
    at = metrics.evaluation_times(df.where("value IS NOT NULL"), ["source"], "ts", "1 minute")
    want = {(r.source, r.ts): r.rate for r in metrics.rate(df, ["source"], "ts", "value", "5 minutes", at=at).collect()}
    got = {(r.source, r.ts): r.rate for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == set(want) and len(want) > 200
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=1e-12)


def test_alerts_run_from_one_checkpoint(spark, tmp_path):
    schema = "ts timestamp, fuel string, mw double"
    rule = alerts.Rule("HighCoalPercentage", "warning", threshold=60.0, min_count=2)
    stretch = lambda n, p: [(minutes(5 * n), "Coal", p), (minutes(5 * n), "Gas", 100.0 - p)]
    # The coal share stays high until data stops; rows of no fuel go on after it.
    for part in ([*stretch(0, 70.0), *stretch(1, 80.0)], stretch(2, 90.0), [(minutes(200), None, None)]):
        land(spark, tmp_path / "in", part, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        checkpoint, log = stream_alerts.run_alerts(
            spark, stream, rule, "5 minutes", str(tmp_path / "run"), "ts", "fuel", "coal", "mw", "5 minutes"
        )
    found = [tuple(r)[2:] for r in spark.read.parquet(log).orderBy("at").collect()]
    assert found == [("firing", minutes(5), T0, 2), ("resolved", minutes(15), T0, 3)]
    assert {p.name for p in (tmp_path / "run").iterdir()} == {"checkpoint", "changes"}
    assert checkpoint == str(tmp_path / "run" / "checkpoint")


def test_a_silent_series_leaves_the_state(spark, tmp_path):
    schema = "key string, ts timestamp, y double"
    half = lambda n: T0 + timedelta(minutes=30 * n)
    parts = [
        [(k, half(i), 0.1 * i) for k in "ab" for i in range(5)],
        [("a", half(i), 0.1 * i) for i in range(5, 60)],
        [("a", half(60), 1.0)],
    ]
    for part in parts:
        land(spark, tmp_path / "in", part, schema)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        made = stream_forecast.forecast_stream(stream, ["key"], "ts", "y", window="6 hours", model="linear", horizon=1)
        start(made.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    reader = spark.read.format("statestore").load(str(tmp_path / "c"))
    assert rows(reader.select("key.key")) == [("a",)]
    assert spark.read.parquet(str(tmp_path / "out")).where("key = 'b'").count() == 1


def test_errors_of_two_streams_equal_the_score(spark, tmp_path):
    rng = random.Random(4)
    half = lambda n: T0 + timedelta(minutes=30 * n)
    data = [(k, half(i), rng.choice([0.0, 0.5, 1.0, 2.0])) for k in "ab" for i in range(60)]
    schema = "key string, event_time timestamp, y double"
    df = spark.createDataFrame(data, schema)
    made = forecast.linear(df, ["key"], "event_time", "y", horizon=2, origins="all")
    kind = made.schema
    cuts = [half(0), half(20), half(40), half(99)]
    for low, high in zip(cuts, cuts[1:], strict=False):
        # Forecasts come with their origins; values of the last hour come with the next part.
        made.where((F.col("origin_time") >= low) & (F.col("origin_time") < high)).write.mode("append").parquet(str(tmp_path / "made"))
        behind = timedelta(hours=1)
        chosen = (F.col("event_time") >= low - behind) & (F.col("event_time") < (high - behind if high < cuts[-1] else high))
        df.where(chosen).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        found = stream_forecast.error_stream(
            spark.readStream.schema(kind).parquet(str(tmp_path / "made")),
            spark.readStream.schema(schema).parquet(str(tmp_path / "in")),
            ["key"], "event_time", "y", delay="3 hours",
        )
        start(found.writeStream.format("parquet").option("path", str(tmp_path / "out")), str(tmp_path / "c"))
    out = spark.read.parquet(str(tmp_path / "out"))
    got = {r.key: (r.pairs, r.mape) for r in out.groupBy("key").agg(F.count("error").alias("pairs"), (F.avg("error") * 100).alias("mape")).collect()}
    want = {r.key: (r.pairs, r.mape) for r in forecast.score(made, df, ["key"], "event_time", "y").collect()}
    assert set(got) == set(want) == {"a", "b"}
    for key, (pairs, error) in want.items():
        assert got[key] == (pairs, pytest.approx(error))


def test_an_outbox_sends_a_replayed_batch_with_the_same_keys(spark, tmp_path):
    schema = "k string, v int"
    encode = lambda batch: batch.select(
        F.to_json(F.struct("k", "v")).alias("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("v").cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    writer = sinks.outbox(str(tmp_path / "outbox"), encode, "parquet", str(tmp_path / "sent"))

    def run():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        sinks.fan_out(stream, {"topic": writer}, str(tmp_path / "c"))

    for part in range(3):
        # Equal messages are messages of their own.
        land(spark, tmp_path / "in", [("a", part), ("a", part), ("b", part)], schema)
        run()
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    sent = readers.messages(spark, "parquet", str(tmp_path / "sent"))
    assert sent.count() == 12 and readers.once(sent).count() == 9
    received = spark.readStream.schema(schemas.MESSAGE_LOG).parquet(str(tmp_path / "sent"))
    once = readers.once(readers.decode_value(received))
    start(once.writeStream.format("parquet").option("path", str(tmp_path / "once")), str(tmp_path / "c2"))
    assert rows(spark.read.parquet(str(tmp_path / "once")).groupBy("value").count().select("count")) == [(1,)] * 3 + [(2,)] * 3
    no_key = sent.withColumn("key", F.lit(None).cast("string"))
    assert readers.once(no_key).count() == 12
    assert len(list((tmp_path / "outbox").iterdir())) == 1


@pytest.fixture
def small_blocks(spark):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "4096")
    yield
    spark.conf.set(setting, before)


def test_a_large_file_is_read_by_many_tasks_with_the_same_offsets(spark, tmp_path, small_blocks):
    rng = random.Random(7)
    texts = {
        name: ["x" * rng.choice([0, 0, 3, 40, 900]) + str(i) * (rng.random() < 0.9) for i in range(n)]
        for name, n in (("a", 900), ("b", 1), ("c", 40), ("d", 700))
    }
    for name, lines in texts.items():
        (tmp_path / f"{name}.txt").write_bytes((("\r\n" if name == "d" else "\n").join(lines) + "\n").encode())
    (tmp_path / "e.txt").write_bytes(b"no end of line")
    found = readers.messages(spark, "text", str(tmp_path))
    assert found.rdd.getNumPartitions() > 20
    got = {}
    for r in found.collect():
        got[r.arrival.source.rsplit("/", 1)[1][0], r.arrival.offset] = r.value
    want = {(name, i): line for name, lines in texts.items() for i, line in enumerate(lines)}
    assert got == want | {("e", 0): "no end of line"}
    text = plan(found)
    assert "Python" not in text and "SortMergeJoin" not in text


def test_a_large_document_is_picked_by_many_tasks(spark, tmp_path, small_blocks):
    landing = tmp_path / "landing"
    landing.mkdir()
    want = []
    for name, header in (("a", "fuel_type,unit_id,note,generated_mw,trading_interval"), ("b", "unit_id,trading_interval,generated_mw")):
        lines = [header]
        for i in range(400):
            values = {"fuel_type": "Coal", "unit_id": f"U{i}", "note": "x" * (i % 50), "generated_mw": f"{i}.5", "trading_interval": "2024-01-01 00:00:00"}
            lines.append(",".join(values[c] for c in header.split(",")))
            want.append((T0, f"U{i}", i + 0.5, "Coal" if name == "a" else None))
        (landing / f"{name}.csv").write_text("\n".join(lines) + "\n")
    found = readers.landing_feed(spark, str(landing), schemas.DISPATCH_MESSAGE)
    assert rows(found) == sorted(want, key=repr)
    topic = stream_feed.topic_writer(
        lambda df: sinks.encode_csv(df, [f.name for f in schemas.DISPATCH_MESSAGE]), "text", str(tmp_path / "topic")
    )
    for _ in range(2):
        stream_feed.run_feed(spark, str(landing), schemas.DISPATCH_MESSAGE, topic, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "topic")).count() == 800
    (landing / "c.csv").write_text("unit_id\nU9\n")
    stream_feed.run_feed(spark, str(landing), schemas.DISPATCH_MESSAGE, topic, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "topic")).count() == 801
