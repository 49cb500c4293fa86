"""Alert rules: conditions that hold for some time, slow runs, and grouping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import shift
from gridlake.operators.ordered import bucket_width, previous, running_sum


@dataclass(frozen=True)
class Rule:
    alertname: str
    severity: str
    threshold: float | None = None
    for_duration: str | None = None
    min_count: int | None = None


# The alert rules. The share rule also exists as "above 70 % for 3 intervals", the forecast rule also with
# 25 %.
HIGH_COAL = Rule("HighCoalPercentage", "warning", threshold=60.0, for_duration="5 minutes")
HIGH_COAL_INTERVALS = Rule("HighCoalPercentage", "warning", threshold=70.0, min_count=3)
RUN_FAILURE = Rule("PipelineFailure", "critical", threshold=0.0, for_duration="1 minute")
FORECAST_ERROR = Rule("ForecastError", "warning", threshold=20.0)
FORECAST_ERROR_25 = Rule("ForecastError", "warning", threshold=25.0)
SLOW_BATCH = Rule("BatchDuration", "critical", for_duration="10 minutes")
RESOLVE_TIMEOUT = "5 minutes"


def sustained(
    df: DataFrame,
    labels: Sequence[str],
    ts: str,
    condition: str,
    step: str,
    for_duration: str | None = None,
    min_count: int | None = None,
    value: str | None = None,
    width: str | Column = "1 day",
    resolve_timeout: str = RESOLVE_TIMEOUT,
) -> DataFrame:
    """Stretches in which ``condition`` (boolean; NULL is false) holds in every sample and no gap exceeds ``step``.

    One row per stretch: ``started_at`` and ``ended_at`` (first and last true sample), ``n``, ``peak`` of ``value``, and
    ``resolved_at``: the false sample that ended it, or ``resolve_timeout`` after the last sample when data stopped.
    ``for_duration`` keeps stretches at least that long, ``min_count`` those with that many samples. Several samples of
    one label set at one time are taken as one, which holds when all of them do.
    """
    cut = bucket_width(df, labels, ts, width)
    peak = [F.max(value).alias("__value")] if value else []
    holds = F.bool_and(F.coalesce(F.col(condition), F.lit(False))).alias("__true")
    rows = df.groupBy(*labels, ts).agg(holds, *peak)
    rows = previous(rows, labels, ts, {"__before": "__true", "__since": ts}, cut)
    near = F.col(ts) <= shift(F.col("__since"), step)
    follows = F.coalesce(F.col("__before") & near, F.lit(False))
    starts = F.col("__true") & ~follows
    rows = rows.withColumn("__ends", ~F.col("__true") & follows)
    numbered = running_sum(rows, labels, ts, {"__stretch": starts.cast("bigint")}, cut)
    is_true = F.col("__true")
    stretches = (
        numbered.where(is_true | F.col("__ends"))
        .groupBy(*labels, "__stretch")
        .agg(
            F.min(F.when(is_true, F.col(ts))).alias("started_at"),
            F.max(F.when(is_true, F.col(ts))).alias("ended_at"),
            F.count(F.when(is_true, F.lit(1))).alias("n"),
            *([F.max(F.when(is_true, F.col("__value"))).alias("peak")] if value else []),
            F.min(F.when(F.col("__ends"), F.col(ts))).alias("__false_at"),
        )
    )
    stretches = stretches.withColumn(
        "resolved_at", F.coalesce("__false_at", shift(F.col("ended_at"), resolve_timeout))
    ).drop("__false_at", "__stretch")
    if for_duration is not None:
        stretches = stretches.where(F.col("ended_at") >= shift(F.col("started_at"), for_duration))
    if min_count is not None:
        stretches = stretches.where(F.col("n") >= min_count)
    return stretches


def threshold_alert(
    df: DataFrame, labels: Sequence[str], ts: str, value: str, rule: Rule, step: str, width: str | Column = "1 day"
) -> DataFrame:
    """Alert rows of a rule "value above threshold, sustained"."""
    judged = df.withColumn("__over", F.col(value) > F.lit(rule.threshold))
    found = sustained(judged, labels, ts, "__over", step, rule.for_duration, rule.min_count, value, width)
    return _named(found, rule)


def status_alert(
    df: DataFrame, labels: Sequence[str], ts: str, status: str, step: str, rule: Rule = RUN_FAILURE, width: str | Column = "1 day"
) -> DataFrame:
    """Alert rows of a rule "status equals the threshold, sustained"."""
    judged = df.withColumn("__failed", F.col(status) == F.lit(rule.threshold))
    return _named(sustained(judged, labels, ts, "__failed", step, rule.for_duration, rule.min_count, None, width), rule)


def _named(stretches: DataFrame, rule: Rule) -> DataFrame:
    return stretches.select(F.lit(rule.alertname).alias("alertname"), F.lit(rule.severity).alias("severity"), "*")


def drift_alert(scores: DataFrame, error: str = "mape", rule: Rule = FORECAST_ERROR) -> DataFrame:
    """Alert rows for scored series whose error is above the threshold."""
    return _named(scores.where(F.col(error) > rule.threshold), rule)


def slow_runs(runs: DataFrame, started: str, finished: str, limit: str = "10 minutes") -> DataFrame:
    """Runs that took longer than ``limit``."""
    return runs.where(F.col(finished) > shift(F.col(started), limit))


def group_alerts(alerts: DataFrame, by: Sequence[str] = ("alertname",)) -> DataFrame:
    """One notification row per group: how many alerts, the first start, the last resolution."""
    return alerts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min("started_at").alias("first_started_at"),
        F.max("resolved_at").alias("last_resolved_at"),
    )
