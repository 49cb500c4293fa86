"""Sustained alerts on a stream: intervals are closed by the watermark, and a state for each set of labels follows them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from gridlake.functions.timeaxis import micros
from gridlake.operators.alerts import RESOLVE_TIMEOUT, Rule
from gridlake.session import settings
from gridlake.streaming.runner import start

STATE = "started bigint, last bigint, n bigint, firing boolean, due bigint"
CHANGE = ("state", "at", "started", "n")
TIME = "__time"


def share_stream(
    stream: DataFrame,
    ts: str,
    step: str,
    label: str,
    match: str,
    value: str,
    delay: str = "1 hour",
    labels: Sequence[str] = (),
) -> DataFrame:
    """``(labels, ts, percent)`` of every interval the watermark has closed; ``ts`` is its start.

    Rows that come more than ``delay`` late are not counted in; :class:`gridlake.streaming.late.DroppedRows` writes down
    how many there were, and :func:`gridlake.streaming.late.split_late` keeps them.
    """
    return _shares(stream, ts, step, label, match, value, delay, labels).drop(TIME)


def _shares(
    stream: DataFrame, ts: str, step: str, label: str, match: str, value: str, delay: str, labels: Sequence[str]
) -> DataFrame:
    timed = stream.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", delay)
    part = F.sum(F.when(F.lower(label) == match.lower(), F.col(value)))
    return (
        timed.groupBy(*labels, F.window("__ts", step).alias("interval"))
        .agg((F.try_divide(part, F.sum(value)) * 100).alias("percent"))
        # The time that the state operator behind it goes by.
        .select(*labels, F.col("interval")["start"].alias("ts"), "percent", F.window_time("interval").alias(TIME))
    )


def alert_stream(
    shares: DataFrame,
    rule: Rule,
    step: str,
    ts: str = "ts",
    value: str = "percent",
    labels: Sequence[str] = (),
    delay: str = "0 seconds",
) -> DataFrame:
    """``firing`` and ``resolved`` changes: ``(alertname, labels, severity, state, at, started_at, n)``.

    Each set of labels has an alert of its own. It fires at the sample that completes ``for_duration`` or ``min_count``
    and resolves at the first sample below the threshold, or ``resolve_timeout`` after its last sample when none follows
    within ``step``: at the next sample, or by a timer once the watermark has passed the time at which that sample
    would have been known. The watermark is the stream's own, where it has one (:func:`share_stream` in one query), or the
    newest sample of all series less ``delay``. One row per interval reaches the state, whatever the number of raw rows.
    """
    if TIME not in shares.columns:
        shares = shares.withColumn(TIME, F.col(ts)).withWatermark(TIME, delay)
    series = ["alertname", *labels]
    samples = shares.select(
        F.lit(rule.alertname).alias("alertname"),
        *labels,
        F.unix_micros(ts).alias("at"),
        TIME,
        F.coalesce(F.col(value) > F.lit(rule.threshold), F.lit(False)).alias("holds"),
    )
    changes_of = T.StructType(
        [T.StructField("alertname", T.StringType())]
        + [T.StructField(name, shares.schema[name].dataType) for name in labels]
        + [T.StructField(name, T.StringType() if name == "state" else T.LongType()) for name in CHANGE]
    )
    changes = samples.groupBy(*series).transformWithStateInPandas(
        AlertState(rule, micros(step), series), changes_of, "append", "EventTime"
    )
    return changes.select(
        "alertname",
        *labels,
        F.lit(rule.severity).alias("severity"),
        "state",
        F.timestamp_micros("at").alias("at"),
        F.timestamp_micros("started").alias("started_at"),
        "n",
    )


def run_alerts(
    spark: SparkSession,
    raw: DataFrame,
    rule: Rule,
    step: str,
    root: str,
    ts: str,
    label: str,
    match: str,
    value: str,
    delay: str = "1 hour",
    trigger: Mapping[str, object] | None = None,
    labels: Sequence[str] = (),
    partitions: int | None = None,
) -> tuple[str, str]:
    """Run shares and alerts as one query under ``root``; returns the folders of its checkpoint and of the changes.

    Map tasks add the raw rows up, so that few rows reach the state. ``partitions`` is into how many parts it is dealt when
    the checkpoint is made (by default the session's number); one to a few hundred sets of labels is plenty.
    """
    checkpoint, log = f"{root}/checkpoint", f"{root}/changes"
    shares = _shares(raw, ts, step, label, match, value, delay, labels)
    changes = alert_stream(shares, rule, step, labels=labels)
    parts = str(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    with settings(spark, shuffle_partitions=parts):
        start(changes.writeStream.format("parquet").option("path", log), checkpoint, trigger)
    return checkpoint, log


class AlertState(StatefulProcessor):
    """The stretch of true samples of one set of labels, and the timer that ends it when no sample comes."""

    def __init__(self, rule: Rule, step: int, series: list[str]):
        self.step, self.series = step, series
        self.wait = micros(rule.for_duration) if rule.for_duration else 0
        self.count = rule.min_count or 1
        self.silence = micros(RESOLVE_TIMEOUT)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stretch = handle.getValueState("stretch", STATE)

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        started, last, n, firing, due = self.stretch.get() if self.stretch.exists() else (None, None, 0, False, None)
        samples = pd.concat(list(rows)).sort_values("at")
        changes = []
        for ts, holds in zip(samples["at"].tolist(), samples["holds"].tolist()):
            if n and (not holds or ts - last > self.step):
                if firing:
                    changes.append(("resolved", ts if ts - last <= self.step else last + self.silence, started, n))
                started, n, firing = None, 0, False
            if holds:
                started, last, n = (started if n else ts), ts, n + 1
                if not firing and n >= self.count and ts - started >= self.wait:
                    firing = True
                    changes.append(("firing", ts, started, n))
        if due is not None:
            self.handle.deleteTimer(due)
        if n:
            # Milliseconds. A sample within the step would still belong to the alert, and is known a step later.
            due = (last + self.step + max(self.step, self.silence)) // 1000 + 1
            self.handle.registerTimer(due)
            self.stretch.update((started, last, n, firing, due))
        elif self.stretch.exists():
            self.stretch.clear()
        yield from self._told(key, changes)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        if not self.stretch.exists():
            return
        started, last, n, firing, due = self.stretch.get()
        if due == expiredTimerInfo.getExpiryTimeInMs():
            self.stretch.clear()
            yield from self._told(key, [("resolved", last + self.silence, started, n)] if firing else [])

    def _told(self, key: tuple, changes: list[tuple]) -> Iterator[pd.DataFrame]:
        if changes:
            yield pd.DataFrame([(*key, *change) for change in changes], columns=[*self.series, *CHANGE])

    def close(self) -> None:
        pass
