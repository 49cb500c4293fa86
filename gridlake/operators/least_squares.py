"""Trend plus Fourier terms by least squares, for many origins of one series at once (numpy helper of ``forecast``)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd

# Period in days and number of sine/cosine pairs of each season. Every origin is fitted with all seasons of the call; the
# ridge on the seasonal terms keeps a short history from bending to them, the level and the trend are free.
SEASONS = ((1.0, 4), (7.0, 3))
RIDGE = 0.01
DAY = 86_400_000_000

Seasons = tuple[tuple[float, int], ...]


def _features(at: np.ndarray, start: int, length: int, seasons: Seasons) -> np.ndarray:
    """Columns: 1, trend, then the Fourier pairs of the seasons."""
    columns = [np.ones_like(at, dtype=float), (at - start) / length]
    for period, pairs in seasons:
        angle = 2 * np.pi * np.mod(at / DAY, period) / period
        for k in range(1, pairs + 1):
            columns += [np.sin(k * angle), np.cos(k * angle)]
    return np.stack(columns, axis=1)


def _penalty(seasons: Seasons) -> np.ndarray:
    return np.diag([0.0, 0.0, *[RIDGE] * (2 * sum(pairs for _, pairs in seasons))])


def fit_predict(
    at: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    origins: np.ndarray,
    window: int,
    step: int,
    horizon: int,
    min_points: int,
    seasons: Seasons = SEASONS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forecasts from every origin: ``(origin, n, yhat[origin, horizon])``. ``at`` must be ascending and unique, ``origins``
    ascending."""
    first = np.searchsorted(at, origins - window, side="left")
    last = np.searchsorted(at, origins, side="right")
    counts = np.concatenate([[0], np.cumsum(weight)])
    n = counts[last] - counts[first]
    keep = (n >= min_points) & (last - first >= 2)
    origins, first, last, n = origins[keep], first[keep], last[keep], n[keep]
    if not len(origins):
        return origins, n, np.empty((0, horizon))
    yhat = np.empty((len(origins), horizon))
    ahead = step * np.arange(1, horizon + 1)
    for chosen, gram, cross in window_moments(at, y, weight, first, last, window, seasons):
        # Only a window's own moments are in them, and time is counted from its neighbourhood, not from the series' start.
        beta = np.linalg.solve(gram + _penalty(seasons), cross[:, :, None])[:, :, 0]
        times = origins[chosen][:, None] + ahead
        future = _features(times.ravel(), at[first[chosen.start]], window, seasons).reshape(len(beta), horizon, -1)
        yhat[chosen] = np.einsum("ohp,op->oh", future, beta)
    return origins, n, yhat


def window_moments(
    at: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray,
    first: np.ndarray,
    last: np.ndarray,
    window: int,
    seasons: Seasons = SEASONS,
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Gram matrices and cross moments of the points ``first[i]`` to ``last[i]``, for a slice of windows at a time.

    Both ends only move on. Windows that hold one common place, the end of the first of them, are a slice: each is what
    lies before that place, added up backwards from it, and what lies behind, added up forwards. Every point is added at
    most twice, and nothing is ever subtracted, so that a huge value leaves no trace in windows without it.
    """
    begin = 0
    while begin < len(first):
        middle = last[begin]
        end = begin + int(np.searchsorted(first[begin:], middle, side="right"))
        low, high = first[begin], last[end - 1]
        x = _features(at[low:high], at[low], window, seasons)
        weighted = weight[low:high, None] * x
        points = np.concatenate([weighted[:, :, None] * x[:, None, :], (weighted * y[low:high, None])[:, :, None]], axis=2)
        nothing = np.zeros_like(points[:1])
        before = np.concatenate([np.cumsum(points[: middle - low][::-1], axis=0)[::-1], nothing])
        behind = np.concatenate([nothing, np.cumsum(points[middle - low :], axis=0)])
        sums = before[first[begin:end] - low] + behind[last[begin:end] - middle]
        yield slice(begin, end), sums[:, :, :-1], sums[:, :, -1]
        begin = end


def solve_moments(
    keys: Sequence[str], window: int, step: int, horizon: int, min_points: int, seasons: Seasons = SEASONS
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Function for ``mapInPandas`` over one row of moments per series: solve, and predict from its origin."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 2 + 2 * sum(pairs for _, pairs in seasons)
        upper = np.triu_indices(size)
        ahead = step * np.arange(1, horizon + 1)
        for batch in batches:
            batch = batch[(batch["n"] >= min_points) & (batch["__span"] > 0)].reset_index(drop=True)
            if batch.empty:
                continue
            gram = np.zeros((len(batch), size, size))
            gram[:, upper[0], upper[1]] = np.stack(batch["__gram"].to_numpy())
            gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
            cross = np.stack(batch["__cross"].to_numpy())
            beta = np.linalg.solve(gram + _penalty(seasons), cross[:, :, None])[:, :, 0]
            origins = batch["__origin_at"].to_numpy(dtype=np.int64)
            yhat = np.stack(
                [_features(o + ahead, o - window, window, seasons) @ b for o, b in zip(origins, beta, strict=True)]
            )
            out = batch.loc[batch.index.repeat(horizon), [*keys, "__origin_at", "n"]].reset_index(drop=True)
            out["step"] = np.tile(np.arange(1, horizon + 1, dtype=np.int32), len(batch))
            out["yhat"] = yhat.ravel()
            yield out

    return solve


def additive_forecast(
    keys: Sequence[str], window: int, step: int, horizon: int, min_points: int, seasons: Seasons = SEASONS
) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Function for ``applyInPandas`` over the points of one series and chunk."""

    def forecast(points: pd.DataFrame) -> pd.DataFrame:
        points = points.sort_values("__at")
        at = points["__at"].to_numpy(dtype=np.int64)
        origins, n, yhat = fit_predict(
            at,
            points["__y"].to_numpy(dtype=float),
            points["__n"].to_numpy(dtype=float),
            at[points["__origin"].to_numpy(dtype=bool)],
            window,
            step,
            horizon,
            min_points,
            seasons,
        )
        out = pd.DataFrame(
            {
                "__origin_at": np.repeat(origins, horizon),
                "n": np.repeat(n.astype(np.int64), horizon),
                "step": np.tile(np.arange(1, horizon + 1, dtype=np.int32), len(origins)),
                "yhat": yhat.ravel(),
            }
        )
        for position, key in enumerate(keys):
            out.insert(position, key, points[key].iloc[0])
        return out

    return forecast
