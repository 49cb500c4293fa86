"""Counter rates on a stream, at instants on a grid, as :func:`gridlake.operators.metrics.rate` has them at rest."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from gridlake.functions.timeaxis import micros

STATE = "at array<bigint>, value array<double>, done bigint, due bigint"


def rate_stream(
    stream: DataFrame,
    series: Sequence[str],
    ts: str,
    value: str,
    window: str = "5 minutes",
    step: str = "1 minute",
    delay: str = "1 minute",
) -> DataFrame:
    """``(series, ts, rate)``: per-second increase of each counter over the trailing window, at instants every ``step``.

    Instants are those from a series' first to its newest sample. One is evaluated when the watermark (the newest sample of
    all series, less ``delay``) has passed it, so that samples may come in any order within ``delay``. The state of a series
    is its samples of one window. A drop is a reset; of several samples at one time the largest is taken; values that are
    no finite numbers are no samples, and move the watermark only.
    """
    rows = stream.select(
        *series, F.col(ts).cast("timestamp").alias("__time"), F.col(value).cast("double").alias("value")
    ).withWatermark("__time", delay)
    samples = rows.select(*series, "__time", F.unix_micros("__time").alias("at"), "value")
    made = T.StructType(
        [T.StructField(name, stream.schema[name].dataType) for name in series]
        + [T.StructField("at", T.LongType()), T.StructField("rate", T.DoubleType())]
    )
    found = samples.groupBy(*series).transformWithStateInPandas(
        RateState(list(series), micros(window), micros(step)), made, "append", "EventTime"
    )
    return found.select(*series, F.timestamp_micros("at").alias(ts), "rate")


class RateState(StatefulProcessor):
    """A series' samples that a window of an instant to come may hold, and the last instant evaluated."""

    def __init__(self, series: list[str], window: int, step: int):
        self.series, self.window, self.step = series, window, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getValueState("samples", STATE)

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        new = pd.concat([r[["at", "value"]] for r in rows])
        new = new[np.isfinite(new["value"].to_numpy(dtype=float))]
        yield from self._evaluated(key, new, timerValues)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        yield from self._evaluated(key, pd.DataFrame({"at": [], "value": []}), timerValues)

    def _evaluated(self, key: tuple, new: pd.DataFrame, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        at, value, done, due = self.samples.get() if self.samples.exists() else ((), (), None, None)
        known = pd.concat([pd.DataFrame({"at": list(at), "value": list(value)}), new])
        if known.empty:
            return
        known = known.groupby("at", sort=True)["value"].max()
        at, value = known.index.to_numpy(dtype=np.int64), known.to_numpy(dtype=float)
        first = -(-int(at[0]) // self.step) * self.step if done is None else done + self.step
        newest = int(at[-1]) // self.step * self.step
        past = timerValues.getCurrentWatermarkInMs() * 1000
        last = min(newest, past // self.step * self.step)
        instants = np.arange(first, last + 1, self.step, dtype=np.int64)
        made = rates_at(at, value, instants, self.window)
        following = max(first, last + self.step)
        # A sample before the window of the next instant is in none to come; the newest tells where the instants end.
        kept = (at >= following - self.window) | (at == at[-1])
        if due is not None:
            self.handle.deleteTimer(due)
        due = following // 1000 + 1 if following <= newest else None
        if due is not None:
            self.handle.registerTimer(due)
        self.samples.update((at[kept].tolist(), value[kept].tolist(), following - self.step, due))
        if len(made):
            frame = pd.DataFrame({"at": instants[made.index], "rate": made.to_numpy()})
            for index, name in enumerate(self.series):
                frame.insert(index, name, key[index])
            yield frame

    def close(self) -> None:
        pass


def rates_at(at: np.ndarray, value: np.ndarray, instants: np.ndarray, window: int) -> pd.Series:
    """Rates at the instants, by their number, whose window holds two samples. Each window's own increases are added up."""
    grown = np.where(value[1:] >= value[:-1], value[1:] - value[:-1], value[1:])
    low = np.searchsorted(at, instants - window, side="left")
    high = np.searchsorted(at, instants, side="right")
    chosen = np.flatnonzero(high - low > 1)
    sums = [float(grown[low[i] : high[i] - 1].sum()) / (window / 1e6) for i in chosen]
    return pd.Series(sums, index=chosen, dtype=float)
