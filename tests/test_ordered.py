"""The bucketed scans against a plain loop over each series."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.operators import ordered
from gridlake.operators.ordered import previous, running_sum, sweep
from tests.conftest import plan, rows

START = datetime(1969, 12, 30)


def series(seed: int, size: int = 300):
    """Uneven series: one holds most rows, one has a NULL label, and gaps are longer than a bucket."""
    rng = random.Random(seed)
    out, at = [], {}
    for number in range(size):
        key = rng.choices(["hot", "cold", None], [8, 1, 1])[0]
        at[key] = at.get(key, START) + timedelta(seconds=rng.choice([1, 5, 60, 900, 40_000]))
        out.append((number, key, at[key], float(rng.randint(0, 20)) if rng.random() > 0.1 else None))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "id int, key string, ts timestamp_ntz, v double").repartition(5)


def by_key(data):
    found = {}
    for row in sorted(data, key=lambda r: (r[2], r[0])):
        found.setdefault(row[1], []).append(row)
    return found


@pytest.mark.parametrize("width", ["10 minutes", "1 day", "400 days"])
def test_previous(spark, width):
    data = series(1)
    found = previous(frame(spark, data), ["key"], "ts", {"before": "v", "since": "ts"}, width, ["id"])
    expected = []
    for group in by_key(data).values():
        for last, row in zip([None, *group], group):
            expected.append((*row, last[3] if last else None, last[2] if last else None))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", ["10 minutes", "1 day"])
def test_running_sum(spark, width):
    data = series(2)
    found = running_sum(frame(spark, data), ["key"], "ts", {"total": F.col("v")}, width, ["id"])
    expected = []
    for group in by_key(data).values():
        total = 0.0
        for row in group:
            total += row[3] or 0.0
            expected.append((*row, total))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", ["10 minutes", "1 day"])
@pytest.mark.parametrize("window", [timedelta(minutes=10), timedelta(hours=24), timedelta(hours=30)])
@pytest.mark.parametrize("aim", [50_000, 7])
def test_sweep_is_the_inclusive_trailing_window(spark, width, window, aim, monkeypatch):
    monkeypatch.setattr(ordered, "AIM", aim)
    data = series(3)
    df = frame(spark, data + data[:50])
    spans = df.withColumn("leave", F.col("ts") + F.lit(window))
    found = sweep(spans, ["key"], "ts", "leave", {"n": F.lit(1), "total": F.col("v")}, width)
    expected = set()
    for key, group in by_key(data + data[:50]).items():
        for row in group:
            inside = [r for r in group if row[2] - window <= r[2] <= row[2]]
            expected.add((key, row[2], len(inside), sum(r[3] or 0.0 for r in inside)))
    assert rows(found) == sorted(expected, key=repr)


@pytest.mark.parametrize("width", ["7 minutes", "1 minute", "1 day"])
def test_sweep_probes_lie_between_entering_and_leaving(spark, width):
    data = [(1, "a", START, 2.0), (2, "a", START + timedelta(minutes=5), 3.0)]
    spans = frame(spark, data).withColumn("leave", F.col("ts") + F.expr("INTERVAL 5 MINUTES"))
    times = [START - timedelta(1), START, START + timedelta(minutes=5), START + timedelta(minutes=10), START + timedelta(1)]
    probes = spark.createDataFrame([("a", t, i) for i, t in enumerate(times)], "key string, ts timestamp_ntz, tag int")
    found = sweep(spans, ["key"], "ts", "leave", {"total": F.col("v")}, width, probes, ["tag"])
    assert sorted((r.tag, r.total) for r in found.collect()) == [(0, 0.0), (1, 2.0), (2, 5.0), (3, 3.0), (4, 0.0)]


@pytest.mark.parametrize("odd", [float("nan"), float("inf"), 1e16])
@pytest.mark.parametrize("width", ["3 days", "14 days"])
def test_sweep_forgets_what_has_left(spark, odd, width):
    data = [(k, "a", START + timedelta(days=k), odd if k == 3 else 0.1) for k in range(40)]
    df = frame(spark, data)
    spans = df.withColumn("leave", F.col("ts") + F.expr("INTERVAL 14 DAYS"))
    found = sweep(spans, ["key"], "ts", "leave", {"total": F.col("v")}, width)
    trailing = Window.partitionBy("key").orderBy("ts").rangeBetween(-14 * 86400, 0)
    plain = df.withColumn("ts", F.col("ts").cast("timestamp").cast("bigint")).withColumn("total", F.sum("v").over(trailing))
    got = [r.total for r in found.orderBy("ts").collect()]
    want = [r.total for r in plain.orderBy("ts").collect()]
    assert got == pytest.approx(want, rel=1e-12, nan_ok=True) and got[30] == pytest.approx(1.5)


@pytest.mark.parametrize("aim", [3, 40])
def test_buckets_follow_the_data(spark, aim, monkeypatch):
    monkeypatch.setattr(ordered, "AIM", aim)
    data = series(6)
    df = frame(spark, data)
    found = previous(df, ["key"], "ts", {"before": "v"}, "30 days", ["id"])
    expected = []
    for group in by_key(data).values():
        expected += [(*row, last[3] if last else None) for last, row in zip([None, *group], group)]
    assert rows(found) == sorted(expected, key=repr)
    width = df.select(ordered.bucket_width(df, ["key"], "ts", "30 days").alias("w")).first().w
    assert width < 30 * 86_400_000_000 / (100 / aim)


def test_integer_axis_and_no_keys(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(-20, 20)], "at long, v long")
    found = previous(df, [], "at", {"before": "v"}, 7)
    assert rows(found) == sorted([(i, i * i, (i - 1) ** 2 if i > -20 else None) for i in range(-20, 20)], key=repr)


def test_rows_are_shuffled_by_series_and_bucket(spark):
    text = plan(previous(frame(spark, series(4)), ["key"], "ts", {"before": "v"}, "1 day"))
    windows = [line for line in text.splitlines() if "Window [lag(" in line]
    assert windows and any("__bucket" in line.split("windowspecdefinition(")[1].split(" ASC")[0] for line in windows)
