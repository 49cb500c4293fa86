from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlake.operators import alerts, feed, metrics
from tests.conftest import rows

T0 = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def samples(spark, *data):
    return spark.createDataFrame([(s, at(m), float(v)) for s, m, v in data], "s string, ts timestamp_ntz, v double")


def test_rate_with_reset(spark):
    df = samples(spark, ("a", 0, 4), ("a", 1, 10), ("a", 2, 3), ("a", 30, 50), ("a", 31, 53))
    found = metrics.rate(df, ["s"], "ts", "v")
    # 4 -> 10 is +6, 10 -> 3 is a reset and counts 3; the sample after the long gap has no partner.
    assert rows(found) == [
        ("a", at(1), pytest.approx(6 / 300)),
        ("a", at(2), pytest.approx(9 / 300)),
        ("a", at(31), pytest.approx(3 / 300)),
    ]


def test_rate_window_holds_both_ends(spark):
    df = samples(spark, ("a", 0, 0), ("a", 5, 10), ("a", 10, 30))
    found = metrics.rate(df, ["s"], "ts", "v").orderBy("ts")
    assert [tuple(r) for r in found.collect()] == [("a", at(5), 10 / 300), ("a", at(10), 20 / 300)]


def test_rate_against_a_loop_at_samples_and_instants(spark):
    rng = random.Random(5)
    data, now = [], {}
    for _ in range(400):
        s = rng.choices(["hot", "b", None], [8, 1, 1])[0]
        now[s] = now.get(s, 0) + rng.choice([0.25, 1, 2, 9])
        data.append((s, now[s], rng.randint(0, 30)))
    df = samples(spark, *data)
    series = {}
    for s, m, v in sorted(data, key=lambda r: r[1]):
        series.setdefault(s, []).append((m, v))

    def expected(s, minute):
        inside = [(m, v) for m, v in series[s] if minute - 5 <= m <= minute]
        if len(inside) < 2:
            return None
        return sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:])) / 300

    want = [(s, at(m), expected(s, m)) for s, m, _ in data if expected(s, m) is not None]
    have = rows(metrics.rate(df, ["s"], "ts", "v", width="10 minutes"))
    assert [r[:2] for r in have] == [r[:2] for r in sorted(want, key=repr)]
    assert [r[2] for r in have] == pytest.approx([r[2] for r in sorted(want, key=repr)])

    instants = metrics.evaluation_times(df, ["s"], "ts", "3 minutes")
    assert instants.schema["ts"].dataType == df.schema["ts"].dataType
    grid = [(s, m) for s in series for m in range(0, 5000, 3) if series[s][0][0] <= m <= series[s][-1][0]]
    assert rows(instants) == sorted([(s, at(m)) for s, m in grid], key=repr)
    want = sorted([(s, at(m), expected(s, m)) for s, m in grid if expected(s, m) is not None], key=repr)
    have = rows(metrics.rate(df, ["s"], "ts", "v", at=instants))
    assert [r[:2] for r in have] == [r[:2] for r in want]
    assert [r[2] for r in have] == pytest.approx([r[2] for r in want])


def test_extrapolated_rate(spark):
    # Scraped each minute, seen 30 s after the last scrape: 4 minutes covered, both edges half a minute away.
    df = samples(spark, *[("a", m, 100 + 60 * m) for m in range(10)])
    at_instant = spark.createDataFrame([("a", at(9.5))], "s string, ts timestamp_ntz")
    found = metrics.rate(df, ["s"], "ts", "v", at=at_instant, extrapolate=True).collect()
    assert [r.rate for r in found] == [pytest.approx(1.0)]
    # A counter that starts at zero is not stretched to before its start.
    young = samples(spark, ("b", 4, 0), ("b", 5, 60))
    assert metrics.rate(young, ["s"], "ts", "v", extrapolate=True).first().rate == pytest.approx(60 / 300)
    # Half a sample distance is added towards edges that are far away.
    sparse = samples(spark, ("c", 5.5, 1000), ("c", 6.5, 1010))
    probe = spark.createDataFrame([("c", at(9))], "s string, ts timestamp_ntz")
    found = metrics.rate(sparse, ["s"], "ts", "v", at=probe, extrapolate=True).first().rate
    assert found == pytest.approx(10 * (60 + 30 + 30) / 60 / 300)


def test_rate_takes_the_last_of_samples_at_one_time(spark):
    df = samples(spark, ("a", 0, 1), ("a", 1, 9), ("a", 1, 3)).withColumn("n", F.monotonically_increasing_id())
    df = df.withColumn("n", F.when(F.col("v") == 3, 100).otherwise(1))
    assert rows(metrics.rate(df, ["s"], "ts", "v", ties=["n"])) == [("a", at(1), 2 / 300)]


def test_metric_table_and_labels(spark):
    df = spark.createDataFrame([(T0, "Coal", 1), (T0, "Gas", 2)], "t timestamp, fuel string, mw int")
    long = metrics.to_metric(df, "power", "t", "mw", ["fuel"])
    assert long.columns == ["ts", "metric", "labels", "value"]
    assert [r.value for r in metrics.select_metric(long, "power", fuel="coal").collect()] == [1.0]
    assert metrics.select_metric(long, "other").count() == 0


def test_instant_uses_the_newest_value_of_each_series(spark):
    df = samples(spark, ("a", 0, 100), ("a", 2, 1), ("b", 1, 4))
    assert metrics.instant(df, ["s"], "ts", "v").first()[0] == 5.0
    assert metrics.instant(df, ["s"], "ts", "v", "avg").first()[0] == 2.5
    stale = samples(spark, ("a", 0, 100), ("b", 6, 4))
    assert metrics.instant(stale, ["s"], "ts", "v", lookback="5 minutes").first()[0] == 4.0


def test_instants_over_several_days(spark):
    df = samples(spark, ("a", 7, 1), ("a", 60 * 50, 1), ("b", 3, 1), ("b", 4, 1))
    found = rows(metrics.evaluation_times(df, ["s"], "ts", "7 hours"))
    # Aligned to the epoch: the days do not start a new count.
    first = (T0 - datetime(1970, 1, 1)) // timedelta(hours=7)
    grid = [datetime(1970, 1, 1) + timedelta(hours=7) * (first + i) for i in range(12)]
    assert found == sorted([("a", t) for t in grid if at(7) <= t <= at(60 * 50)], key=repr)


def test_mix_and_share_of_an_interval_without_generation(spark):
    df = spark.createDataFrame(
        [(1, "Coal", 3.0), (1, "Gas", 1.0), (2, "Coal", 0.0)],
        "trading_interval int, fuel_type string, generated_mw double",
    )
    assert rows(metrics.generation_mix(df)) == [(1, "coal", 3.0, 75.0), (1, "gas", 1.0, 25.0), (2, "coal", 0.0, None)]
    assert rows(metrics.label_share(df, ["trading_interval"], "fuel_type", "COAL", "generated_mw")) == [
        (1, 75.0),
        (2, None),
    ]


def conditions(spark, *data):
    return spark.createDataFrame([(k, at(m), c) for k, m, c in data], "k string, ts timestamp_ntz, c boolean")


def test_stretches_break_on_false_null_and_gaps(spark):
    df = conditions(
        spark,
        *[("a", 5 * i, c) for i, c in enumerate([True, True, False, True, None, True, True])],
        ("a", 60, True),
        ("b", 0, True),
        (None, 0, True),
        (None, 5, False),
    )
    for width in ("5 minutes", "30 days"):
        found = alerts.sustained(df, ["k"], "ts", "c", "5 minutes", width=width)
        assert rows(found) == sorted(
            [
                ("a", at(0), at(5), 2, at(10)),
                ("a", at(15), at(15), 1, at(20)),
                ("a", at(25), at(30), 2, at(35)),
                ("a", at(60), at(60), 1, at(65)),
                ("b", at(0), at(0), 1, at(5)),
                (None, at(0), at(0), 1, at(5)),
            ],
            key=repr,
        )
    assert alerts.sustained(df, ["k"], "ts", "c", "5 minutes", min_count=2).count() == 2
    assert alerts.sustained(df, ["k"], "ts", "c", "5 minutes", for_duration="5 minutes").count() == 2
    assert alerts.sustained(df, ["k"], "ts", "c", "5 minutes", for_duration="6 minutes").count() == 0
    assert alerts.sustained(df, ["k"], "ts", "c", "1 hour", min_count=3).count() == 1


def test_alert_rules(spark):
    df = spark.createDataFrame([(at(5 * i), p) for i, p in enumerate([70.0, 80.0, 60.0, 61.0])], "ts timestamp, p double")
    found = alerts.threshold_alert(df, [], "ts", "p", alerts.HIGH_COAL, "5 minutes")
    assert [tuple(r) for r in found.collect()] == [
        ("HighCoalPercentage", "warning", at(0), at(5), 2, 80.0, at(10))
    ]
    assert alerts.threshold_alert(df, [], "ts", "p", alerts.HIGH_COAL_INTERVALS, "5 minutes").count() == 0
    status = spark.createDataFrame([(at(i), s) for i, s in enumerate([1, 0, 0, 1])], "ts timestamp, status int")
    failed = alerts.status_alert(status, [], "ts", "status", "1 minute")
    assert [tuple(r) for r in failed.collect()] == [("PipelineFailure", "critical", at(1), at(2), 2, at(3))]
    grouped = alerts.group_alerts(
        found.select("alertname", "started_at", "resolved_at").unionByName(
            failed.select("alertname", "started_at", "resolved_at")
        )
    )
    assert rows(grouped) == [
        ("HighCoalPercentage", 1, at(0), at(10)),
        ("PipelineFailure", 1, at(1), at(3)),
    ]


def test_slow_runs(spark):
    df = spark.createDataFrame([("a", at(0), at(10)), ("b", at(0), at(11)), ("c", at(0), None)], "j string, s timestamp, f timestamp")
    assert [r.j for r in alerts.slow_runs(df, "s", "f").collect()] == ["b"]


def test_payload_changes(spark):
    df = spark.createDataFrame(
        [(1, "x", "A"), (2, "x", "A"), (3, "x", "B"), (4, "x", "A"), (5, "y", "A"), (6, "y", None), (7, "y", None), (8, "y", "A")],
        "n int, feed string, body string",
    )
    for width in (1, 3, 100):
        found = feed.changed_payloads(df, ["feed"], "n", "body", width)
        # A payload without content has no checksum; it counts as a change once, unless it is the first.
        assert sorted(r.n for r in found.collect()) == [1, 3, 4, 5, 6, 8]
    crc = feed.with_checksum(spark.createDataFrame([("123456789",)], "b string"), "b").first()["crc"]
    assert crc == 3421780262
    binary = spark.createDataFrame([(bytearray("hé".encode()),)], "b binary")
    assert feed.decode_payload(binary, "b").first()["b"] == "hé"
