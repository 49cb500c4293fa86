"""Exact ordered scans over long series: previous value, running sum, trailing-window sum.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts a whole series into one task, so one hot series decides the run
time. Here every series is cut into buckets on its ordering axis, and the window runs inside the bucket. What crosses a
bucket edge (the last value before it, the sum before it) comes from a table with one row per (series, bucket), built
with a partial aggregate, and enters the window as the bucket's first row. The result is the same for every width.

The ``width`` of a call is the coarsest cut. If some series has more than ``AIM`` rows in a stretch of that width, all
stretches are cut finer, so that the work of a task follows the data and not the time covered. The count is a scalar
subquery of the plan; no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import floor_to, position, span

_BUCKET = "__bucket"
_SEED = "__seed"

# Rows of a series that one bucket is meant to hold, and the most parts into which a width is cut for that.
AIM = 50_000
PARTS = 1024


def bucket_width(df: DataFrame, keys: Sequence[str], order: str, width: str | int | Column) -> Column:
    """``width``, divided so that the fullest stretch of it has about ``AIM`` rows per part.

    A column is a width found before: callers that scan what they derive from a table measure the table once.
    """
    if isinstance(width, Column):
        return width
    coarse = span(width)
    stretch = floor_to(position(df, order), coarse).alias(_BUCKET)
    counts = df.groupBy(*keys, stretch).agg(F.count(F.lit(1)).alias("__n"))
    parts = F.least(F.greatest(F.ceil(F.max("__n") / F.lit(AIM)), F.lit(1)), F.lit(PARTS))
    finer = F.greatest(F.floor(F.lit(coarse) / parts), F.lit(1)).cast("bigint")
    return counts.agg(F.coalesce(finer, F.lit(coarse).cast("bigint")).alias("width")).scalar()


def _with_bucket(df: DataFrame, keys: Sequence[str], order: str, width: str | int | Column) -> DataFrame:
    bucket = floor_to(position(df, order), bucket_width(df, keys, order, width))
    return df.withColumns({_BUCKET: bucket, _SEED: F.lit(0)})


def _seeded(rows: DataFrame, seeds: DataFrame) -> DataFrame:
    return rows.unionByName(seeds.withColumn(_SEED, F.lit(1)), allowMissingColumns=True)


def _inside(keys: Sequence[str], order: str, ties: Sequence[str]):
    """Order within a bucket: its seed comes first."""
    return Window.partitionBy(*keys, _BUCKET).orderBy(F.desc(_SEED), order, *ties)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Mapping[str, str],
    width: str | int | Column,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add, for every ``new: old`` in ``columns``, the value of ``old`` in the row before (NULL in a series' first)."""
    rows = _with_bucket(df, keys, order, width)
    olds = list(dict.fromkeys(columns.values()))
    if ties:
        # A rank limits the rows that a task sends to one per bucket; an aggregate by a struct would sort them all.
        latest = Window.partitionBy(*keys, _BUCKET).orderBy(*[F.desc_nulls_last(c) for c in (order, *ties)])
        ranked = rows.select(*dict.fromkeys([*keys, _BUCKET, order, *ties, *olds]))
        lasts = ranked.withColumn("__rank", F.row_number().over(latest)).where("__rank = 1")
        lasts = lasts.select(*keys, _BUCKET, *[F.col(old).alias(f"__last_{old}") for old in olds])
    else:
        lasts = rows.groupBy(*keys, _BUCKET).agg(*[F.max_by(old, order).alias(f"__last_{old}") for old in olds])
    before = Window.partitionBy(*keys).orderBy(_BUCKET)
    seeds = lasts.select(
        *keys,
        _BUCKET,
        *[F.lag(f"__last_{old}").over(before).alias(f"__last_{old}") for old in olds],
        F.lag(_BUCKET).over(before).alias("__at"),
    )
    values = [F.col(f"__last_{old}").alias(old) for old in olds if old not in keys]
    seeds = seeds.where("__at IS NOT NULL").select(*keys, _BUCKET, *values)
    inside = _inside(keys, order, ties)
    marked = _seeded(rows, seeds).withColumns({new: F.lag(old).over(inside) for new, old in columns.items()})
    return marked.where(F.col(_SEED) == 0).select(*df.columns, *columns)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Mapping[str, Column],
    width: str | int | Column,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add running sums (up to and with the row itself) of the given expressions; NULL counts as 0."""
    rows = _with_bucket(df, keys, order, width)
    kinds = df.select(*[value.alias(name) for name, value in columns.items()]).agg(*[F.sum(n).alias(n) for n in columns])
    zero = {name: F.lit(0).cast(kinds.schema[name].dataType) for name in columns}
    rows = rows.withColumns(
        {f"__v_{n}": F.coalesce(value.cast(kinds.schema[n].dataType), zero[n]) for n, value in columns.items()}
    )
    values = [f"__v_{name}" for name in columns]
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, _BUCKET).agg(*[F.sum(v).alias(v) for v in values])
    seeds = totals.select(*keys, _BUCKET, *[F.sum(v).over(before).alias(v) for v in values])
    seeds = seeds.where(F.col(values[0]).isNotNull())
    inside = _inside(keys, order, ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = _seeded(rows, seeds).withColumns({name: F.sum(f"__v_{name}").over(inside) for name in columns})
    return summed.where(F.col(_SEED) == 0).select(*df.columns, *columns)


# Order of the kinds of rows that meet at one instant of a sweep: a span holds both its ends.
ENTER, PROBE, LEAVE = 0, 1, 2


def sweep(
    spans: DataFrame,
    keys: Sequence[str],
    enter: str,
    leave: str,
    measures: Mapping[str, Column],
    width: str | int | Column,
    probes: DataFrame | None = None,
    extra: Sequence[str] = (),
    merge: bool = True,
    newest: Sequence[str] = (),
) -> DataFrame:
    """Sums of ``measures`` over all spans that hold an instant, ends included.

    For an instant in a bucket these are the spans entered in the bucket up to then, added up forwards; those left in
    the bucket from then on, added up backwards; and those that cover the bucket, which are summed by the buckets of
    their ends and arrive as one row. Nothing is carried from bucket to bucket and taken away later, so a value that
    has left the window leaves no trace, be it NaN, infinite or very large. (A span that begins and ends in one bucket
    is the exception: it is added and taken away there.)

    Without ``probes`` the result has one row per span, and spans that enter at one instant must end at one instant.
    ``probes`` carries ``keys``, ``enter`` and the ``extra`` columns, and gives one row per probe. Equal spans are added
    up first, before the exchange, which also takes care of copies; ``merge=False`` skips that for spans known to
    differ. ``newest`` adds columns of the last span entered before the instant (with ``merge=False`` only). ``width``
    should be about the length of a span: a bucket is told of every pair of buckets whose spans cover it.
    """
    if newest and merge:
        raise ValueError("newest needs merge=False")
    names = list(measures)
    if merge:
        spans = spans.groupBy(*keys, enter, leave).agg(*[F.sum(value).alias(n) for n, value in measures.items()])
    else:
        last = [F.col(c).alias(f"__newest_{c}") for c in newest]
        spans = spans.select(*keys, enter, leave, *[value.alias(n) for n, value in measures.items()], *last)
    size = bucket_width(spans, keys, enter, width)
    placed = spans.withColumns(
        {"__from": floor_to(position(spans, enter), size), "__to": floor_to(position(spans, leave), size)}
    )
    events = _events(placed, keys, enter, leave, names).unionByName(
        _covers(placed, keys, enter, names, newest, size), allowMissingColumns=True
    )
    wanted = ENTER
    if probes is not None:
        wanted = PROBE
        marks = probes.select(*keys, enter, *extra).withColumns(
            {"__side": F.lit(PROBE), _SEED: F.lit(0), _BUCKET: floor_to(position(probes, enter), size)}
        )
        events = events.unionByName(marks, allowMissingColumns=True)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    forwards = Window.partitionBy(*keys, _BUCKET).orderBy(F.desc(_SEED), enter, "__side").rowsBetween(*so_far)
    backwards = Window.partitionBy(*keys, _BUCKET).orderBy(F.desc(enter), F.desc("__side")).rowsBetween(*so_far)
    sums = events.withColumns(
        {
            **{n: F.sum(f"__on_{n}").over(forwards) for n in names},
            **{c: F.last(f"__newest_{c}", ignorenulls=True).over(forwards) for c in newest},
            **{f"__back_{n}": F.sum(f"__off_{n}").over(backwards) for n in names},
        }
    )
    zero = {n: F.lit(0).cast(sums.schema[n].dataType) for n in names}
    total = [(F.coalesce(F.col(n), zero[n]) + F.coalesce(F.col(f"__back_{n}"), zero[n])).alias(n) for n in names]
    return sums.where((F.col("__side") == wanted) & (F.col(_SEED) == 0)).select(*keys, enter, *extra, *total, *newest)


def _events(placed: DataFrame, keys: Sequence[str], enter: str, leave: str, names: Sequence[str]) -> DataFrame:
    """An entering and a leaving row per span; ``enter`` becomes the time of either."""
    side = F.col("__side")
    within = F.col("__from") == F.col("__to")
    rows = placed.withColumn("__side", F.explode(F.array(F.lit(ENTER), F.lit(LEAVE))))
    return rows.select(
        *keys,
        F.when(side == LEAVE, F.col(leave)).otherwise(F.col(enter)).alias(enter),
        "__side",
        F.when(side == LEAVE, F.col("__to")).otherwise(F.col("__from")).alias(_BUCKET),
        F.lit(0).alias(_SEED),
        *[F.when(side == ENTER, F.col(n)).when(within, -F.col(n)).alias(f"__on_{n}") for n in names],
        *[F.when((side == LEAVE) & ~within, F.col(n)).alias(f"__off_{n}") for n in names],
        *[F.when(side == ENTER, F.col(c)).alias(c) for c in placed.columns if c.startswith("__newest_")],
    )


def _covers(
    placed: DataFrame, keys: Sequence[str], enter: str, names: Sequence[str], newest: Sequence[str], size: Column
) -> DataFrame:
    """First rows of the buckets: the sums of the spans that cover them, and the last span entered before them."""
    last = [f"__newest_{c}" for c in newest]
    ends = placed.where("__from < __to").groupBy(*keys, "__from", "__to").agg(
        *[F.sum(n).alias(n) for n in names],
        F.max(enter).alias("__entered"),
        *[F.max_by(c, enter).alias(c) for c in last],
    )
    # Only the last span entered may still matter in the bucket in which it is left.
    until = F.col("__to") if newest else F.col("__to") - size
    start = F.col("__from") + size
    covered = ends.withColumn(_BUCKET, F.explode(F.when(start <= until, F.sequence(start, until, size))))
    inside = F.col(_BUCKET) < F.col("__to")
    return (
        covered.groupBy(*keys, _BUCKET)
        .agg(
            *[F.sum(F.when(inside, F.col(n))).alias(f"__on_{n}") for n in names],
            *[F.max_by(c, "__entered").alias(c) for c in last],
        )
        .withColumn(_SEED, F.lit(1))
    )


def overlapping_chunks(df: DataFrame, keys: Sequence[str], ts: str, window: str) -> DataFrame:
    """Cut series into chunks as long as ``window`` and give every chunk the rows its trailing windows reach back to.

    Each row appears in its own chunk (``__own`` true) and, as history only, in the next one. ``__chunk`` is the start
    of the chunk in microseconds, ``__at`` the row's position relative to it. A chunk holds all rows of a series within
    twice the window, so this is for series with a bounded number of points per window; use :func:`sweep` for raw rows.
    """
    length = span(window)
    own = F.explode(F.array(F.lit(True), F.lit(False)))
    placed = df.withColumns({"__position": position(df, ts), "__own": own})
    first = floor_to(F.col("__position"), length)
    chunk = F.when(F.col("__own"), first).otherwise(first + F.lit(length))
    return placed.withColumn("__chunk", chunk).withColumn("__at", F.col("__position") - F.col("__chunk")).drop(
        "__position"
    )
