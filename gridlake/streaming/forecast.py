"""Forecasts on a stream of values: keyed state holds each series' trailing window."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridlake.functions.timeaxis import iso_text, micros, position, steps_after
from gridlake.operators.forecast import HORIZON, MIN_POINTS, STEP, WINDOW, usable
from gridlake.operators.least_squares import SEASONS, Seasons, fit_predict
from gridlake.session import settings
from gridlake.sources.sinks import Writer, batch_key, encode_json, ensure_table, fan_out, overwrite_table, publish
from gridlake.streaming import compaction

STATE = T.StructType(
    [T.StructField("at", T.ArrayType(T.LongType())), T.StructField("y", T.ArrayType(T.DoubleType()))]
)


def forecast_stream(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    y: str,
    window: str = WINDOW,
    step: str = STEP,
    horizon: int = HORIZON,
    min_points: int = MIN_POINTS,
    model: str = "additive",
    emit: str = "latest",
    seasons: Seasons = SEASONS,
    silence: str | None = None,
) -> DataFrame:
    """``(keys, origin_time, n, step, event_time, yhat)`` for new points of each series.

    ``emit="every"`` forecasts from every new point, ``"latest"`` once per series and batch from its newest. The state
    of a series is its points of the last window, one per distinct time: a point sent twice replaces itself. A point older
    than the window of the newest one is used for its own batch only.

    ``silence`` (by default the window) is how far a series may stay behind the newest time of all series: then its state
    times out, with the next batch, and points that old are dropped by the watermark.
    """
    silence = silence or window
    series = list(keys) or ["series"]
    rows = stream if keys else stream.withColumn("series", F.lit(y))
    seasons = seasons if model == "additive" else ()
    points = (
        rows.where(usable(ts, y))
        .select(*series, position(rows, ts).alias("at"), F.col(y).cast("double").alias("y"))
        .withColumn("__time", F.timestamp_micros("at"))
        .withWatermark("__time", silence)
    )
    fields = [T.StructField(k, rows.schema[k].dataType) for k in series] + [
        T.StructField("origin_at", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("step", T.IntegerType()),
        T.StructField("yhat", T.DoubleType()),
    ]
    fold = _folder(series, micros(window), micros(step), horizon, min_points, seasons, emit == "every")
    found = points.groupBy(*series).applyInPandasWithState(
        fold, T.StructType(fields), STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    timed = found.withColumn("origin_time", F.timestamp_micros("origin_at"))
    event_time = steps_after(F.col("origin_time"), step, F.col("step")).alias("event_time")
    return timed.select(*keys, "origin_time", "n", "step", event_time, "yhat")


def _folder(
    series: list[str], window: int, step: int, horizon: int, min_points: int, seasons: Seasons, every: bool
) -> Callable[[Any, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known: dict[int, float] = dict(zip(*state.get)) if state.exists else {}
        new: set[int] = set()
        newest = max(known, default=None)
        for batch in batches:
            known.update(zip(batch["at"].tolist(), batch["y"].tolist()))
            if every:
                new.update(batch["at"].tolist())
            newest = max(known)
            if not every:
                known = {t: v for t, v in known.items() if t >= newest - window}
        at = np.array(sorted(known), dtype=np.int64)
        y = np.array([known[t] for t in at.tolist()])
        origins = np.array(sorted(new), dtype=np.int64) if every else at[-1:]
        made, n, yhat = fit_predict(at, y, np.ones(len(at)), origins, window, step, horizon, min_points, seasons)
        kept = at >= newest - window
        state.update((at[kept].tolist(), y[kept].tolist()))
        # The watermark, so far behind the newest time of all series, passes the newest point of this one.
        state.setTimeoutTimestamp(max(newest // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if not len(made):
            return
        out = pd.DataFrame(
            {
                "origin_at": np.repeat(made, horizon),
                "n": np.repeat(n.astype(np.int64), horizon),
                "step": np.tile(np.arange(1, horizon + 1, dtype=np.int32), len(made)),
                "yhat": yhat.ravel(),
            }
        )
        for index, name in enumerate(series):
            out.insert(index, name, key[index])
        yield out

    return fold


def error_stream(
    forecasts: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str],
    ts: str,
    y: str,
    step: int = 1,
    delay: str = "1 day",
) -> DataFrame:
    """``(keys, ts, yhat, actual, error)`` of the forecasts made ``step`` steps ahead, when the value has come.

    Both streams have a watermark of ``delay``: a forecast waits for its value, or a value for its forecast, until the
    newest time of either stream is that far beyond it, and is then forgotten. ``error`` is relative, and NULL where the
    value is zero; its mean is :func:`gridlake.operators.forecast.mape`.
    """
    made = forecasts.where(F.col("step") == step).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("event_time").cast("timestamp").alias("__for"), "yhat"
    )
    came = actuals.select(*keys, F.col(ts).cast("timestamp").alias(ts), F.col(y).cast("double").alias("actual"))
    same = F.col("__for") == F.col(ts)
    for key in keys:
        same = same & (F.col(f"__{key}") == F.col(key))
    joined = made.withWatermark("__for", delay).join(came.withWatermark(ts, delay), same)
    error = F.abs(F.try_divide(F.col("actual") - F.col("yhat"), F.col("actual")))
    return joined.select(*keys, ts, "yhat", "actual", error.alias("error"))


def topic_writer(fmt: str, path: str | None = None, name: str = "forecast_solar_share", **options: str) -> Writer:
    """Publish forecasts as JSON ``{event_time, <name>}``; text folders are per batch, a broker gets at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(iso_text(F.col("event_time")).alias("event_time"), F.col("yhat").alias(name))
        target = f"{path}/batch_id={batch_key(batch, batch_id)}" if path else None
        publish(encode_json(rows, ["event_time", name]), fmt, target, mode="overwrite", **options)

    return write


def table_writer(table: str, name: str = "forecast_solar_share", fmt: str = "parquet") -> Writer:
    """Keep forecasts in a catalog table partitioned by the day of the forecast time, then by batch.

    A replayed batch replaces its own partitions. :func:`compact` joins the batches of closed days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed("yhat", name).withColumns(
            {"event_date": F.to_date("event_time"), "batch": F.lit(batch_key(batch, batch_id))}
        )
        ensure_table(batch.sparkSession, table, rows.schema, ["event_date", "batch"], fmt)
        overwrite_table(rows, table, "dynamic")

    return write


def compact(spark: SparkSession, table: str, before: str, **options: Any) -> None:
    """Put the batches of every day before the date ``before`` into one partition, in a few large files.

    Run it while no stream writes to those days; :mod:`gridlake.streaming.compaction` says what a stop leaves behind.
    """
    compaction.compact(spark, table, "event_date", before, batch="batch", **options)


def run_forecast(
    shares: DataFrame,
    writers: Mapping[str, Writer],
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    ts: str = "event_time",
    y: str = "solar_share",
    keys: Sequence[str] = (),
    **options: Any,
) -> StreamingQuery:
    """Forecast a stream of shares into all ``writers`` from one run of the model."""
    made = forecast_stream(shares, keys, ts, y, **options)
    # A batch without rows would only look for series to forget, which the next one with rows does as well.
    with settings(shares.sparkSession, streaming_noDataMicroBatches_enabled="false"):
        return fan_out(made, writers, checkpoint, trigger)
