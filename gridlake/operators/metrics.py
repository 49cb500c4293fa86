"""Metric tables: rates, mixes and instant values over long ``(ts, metric, labels, value)`` data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import MICROS, floor_to, micros, position, shift
from gridlake.operators.ordered import bucket_width, previous, sweep
from gridlake.operators.silver import dedupe


def to_metric(df: DataFrame, metric: str, ts: str, value: str, labels: Sequence[str]) -> DataFrame:
    """Long form of a table: ``(ts, metric, labels, value)``; label values are lower-cased text."""
    pairs = [part for name in labels for part in (F.lit(name), F.lower(F.col(name).cast("string")))]
    return df.select(
        F.col(ts).alias("ts"),
        F.lit(metric).alias("metric"),
        F.create_map(*pairs).alias("labels"),
        F.col(value).cast("double").alias("value"),
    )


def select_metric(df: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Rows of one metric whose labels have the given values."""
    rows = df.where(F.col("metric") == metric)
    for name, wanted in labels.items():
        rows = rows.where(F.col("labels")[name] == wanted)
    return rows


def _increases(
    df: DataFrame, series: Sequence[str], ts: str, value: str, window: str, ties: Sequence[str], width: str | int | Column
) -> DataFrame:
    """One span per pair of neighbouring samples: the increase counts while both samples lie in the window."""
    # A value that is no finite number is no sample: it would count as a reset, or poison the sums around it.
    finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
    samples = df.where(finite).select(*series, ts, *ties, F.col(value).alias("__value"))
    if ties:
        samples = dedupe(samples, [*series, ts], list(ties))
    else:
        samples = samples.groupBy(*series, ts).agg(F.max("__value").alias("__value"))
    pairs = previous(samples, series, ts, {"__before": "__value", "__since": ts}, width)
    # A counter that fell was reset, so its whole new value is increase.
    grown = F.when(F.col("__value") >= F.col("__before"), F.col("__value") - F.col("__before")).otherwise(
        F.col("__value")
    )
    return pairs.withColumns({"__increase": grown, "__leave": shift(F.col("__since"), window)}).where(
        F.col("__leave") >= F.col(ts)
    )


def rate(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    window: str = "5 minutes",
    at: DataFrame | None = None,
    ties: Sequence[str] = (),
    width: str | None = None,
    extrapolate: bool = False,
) -> DataFrame:
    """Per-second increase of a counter over the trailing window, at every sample or at the instants in ``at``.

    A drop is a reset. Only increases between two samples inside the window count; instants with fewer than two samples
    give no row. The increase is divided by the window; with ``extrapolate`` it is first stretched to the window's
    edges, as monitoring systems do for counters scraped at intervals (:func:`_stretch`). Of several samples of a series
    at one time the last by ``ties`` is taken, or the largest; NULL and values that are not finite are no samples.
    ``at`` has the series columns and ``ts``. ``width`` is the coarsest cut of a series (by default the window).
    """
    cut = bucket_width(df, series, ts, width or window)
    spans = _increases(df, series, ts, value, window, ties, cut)
    measures = {"__n": F.lit(1).cast("bigint"), "__sum": F.col("__increase")}
    newest: list[str] = []
    if extrapolate:
        spans = spans.withColumns({"__last_at": position(spans, ts), "__last": F.col("__value")})
        measures["__covered"] = F.col("__last_at") - position(spans, "__since")
        measures["__net"] = F.col("__value") - F.col("__before")
        newest = ["__last_at", "__last"]
    found = sweep(spans, series, ts, "__leave", measures, cut, probes=at, merge=False, newest=newest).where("__n > 0")
    increase = F.greatest(F.col("__sum"), F.lit(0.0))
    if extrapolate:
        increase = increase * _stretch(position(found, ts), micros(window), increase)
    return found.select(*series, ts, (increase / F.lit(micros(window) / 1e6)).alias("rate"))


def _stretch(now: Column, window: int, increase: Column) -> Column:
    """Factor from the time between the first and last sample to the part of the window they stand for.

    Each side is stretched to the window's edge when the edge is nearer than 1.1 mean sample distances, else by half a
    distance; to the left never beyond the time at which the counter would have been zero.
    """
    covered = F.col("__covered").cast("double")
    distance = covered / F.col("__n")
    first_at = F.col("__last_at") - F.col("__covered")
    to_start = (first_at - now + F.lit(window)).cast("double")
    to_end = (now - F.col("__last_at")).cast("double")
    near = distance * 1.1
    first = F.col("__last") - F.col("__net")
    to_zero = covered * F.try_divide(first, increase)
    start = F.when(to_start >= near, distance / 2).otherwise(to_start)
    start = F.when((increase > 0) & (first >= 0) & (to_zero < start), to_zero).otherwise(start)
    end = F.when(to_end >= near, distance / 2).otherwise(to_end)
    return F.coalesce(F.try_divide(covered + start + end, covered), F.lit(1.0))


def evaluation_times(df: DataFrame, series: Sequence[str], ts: str, step: str) -> DataFrame:
    """Instants every ``step`` (aligned to the epoch) from the first to the last sample of each series.

    Their number depends on the time covered and the number of series, not on the number of samples. They are listed day
    by day, so a long series does not become one long array.
    """
    pos = position(df, ts)
    width, day = micros(step), MICROS["day"]
    ends = df.groupBy(*series).agg(F.min(pos).alias("__first"), F.max(pos).alias("__last"))
    days = F.sequence(floor_to(F.col("__first"), day), F.col("__last"), F.lit(day))
    by_day = ends.withColumn("__day", F.explode(days))
    start = F.greatest("__first", "__day")
    first = floor_to(start + F.lit(width - 1), width)
    last = floor_to(F.least(F.col("__last"), F.col("__day") + F.lit(day - 1)), width)
    instants = F.when(first <= last, F.sequence(first, last, F.lit(width)))
    kind = df.schema[ts].dataType
    return by_day.select(*series, F.explode(instants).alias("__at")).select(
        *series, F.timestamp_micros("__at").cast(kind).alias(ts)
    )


def rate_by(
    df: DataFrame, series: Sequence[str], by: Sequence[str], ts: str, value: str, window: str, at: DataFrame, **options
) -> DataFrame:
    """``sum by(...) (rate(...))`` at the given instants."""
    return rate(df, series, ts, value, window, at=at, **options).groupBy(ts, *by).agg(F.sum("rate").alias("rate"))


def label_share(df: DataFrame, group: Sequence[str], label: str, match: str, value: str) -> DataFrame:
    """Percentage that one label value has in the total of each group."""
    part = F.sum(F.when(F.lower(label) == match.lower(), F.col(value)))
    return df.groupBy(*group).agg((F.try_divide(part, F.sum(value)) * 100).alias("percent"))


def generation_mix(
    df: DataFrame, ts: str = "trading_interval", label: str = "fuel_type", value: str = "generated_mw"
) -> DataFrame:
    """Generation per interval and source, and its percentage of the interval's total.

    The window runs over the aggregated rows, of which an interval has one per source.
    """
    per_source = df.groupBy(ts, F.lower(label).alias("source")).agg(F.sum(value).alias("mw"))
    total = F.sum("mw").over(Window.partitionBy(ts))
    return per_source.withColumn("percent", F.try_divide(F.col("mw"), total) * 100)


def latest(df: DataFrame, series: Sequence[str], ts: str, value: str, ties: Sequence[str] = ()) -> DataFrame:
    """Newest value of each series: a task sends one row per series, whatever the number of samples."""
    rows = df.where(F.col(ts).isNotNull()).select(*dict.fromkeys([*series, ts, *ties, value]))
    return dedupe(rows, series, [ts, *ties]).select(*series, value)


def instant(
    df: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    agg: str = "sum",
    ties: Sequence[str] = (),
    lookback: str | None = None,
) -> DataFrame:
    """Sum or average of the newest values of all series.

    With ``lookback`` series without a sample that close to the newest of all samples are stale and do not count.
    """
    function: Column = {"sum": F.sum, "avg": F.avg}[agg](value)
    if lookback:
        df = df.where(F.col(ts) >= shift(df.agg(F.max(ts)).scalar(), "-" + lookback))
    return latest(df, series, ts, value, ties).agg(function.alias("value"))
