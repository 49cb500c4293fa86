"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, three times over. A copy's virtual finish time is the number
of words its source has sent up to and including it, divided by the source's target. Copies of all sources are merged
by finish time and cut at the total budget, the sum of the targets. A capped source is used up exactly at time 1.

No source and no range is sorted as a whole. A source of n documents is dealt to about sqrt(n) ranges of the shuffle
hash, and the ranges' sums give each its start. Finish times are cut into ranges alike, ordered by their sums, and only
the range in which the budget ends is sorted. What remains is a single number, the last finish time taken.

Rows equal in id, source and text have one place in their queue and are one row with a count, ``times``, up to the end: sent
one after the other, they may be taken in part like any others. A group of them enters each range of finish times with the
rows that fall into it, so that no task holds a whole group.

Defined cases: null or empty texts have size 0, are never scheduled, and are taken 0 words; a null source is a source,
last in order; which of several equal rows are taken is all the same to ``mixed``, and ``mix`` takes them in the order of
the table; texts of any length are read whole; an empty table gives no rows; other columns pass through ``mix`` unread.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import WORD, columns_of, free, measured, text_or_empty, written

WEIGHTS = (5, 2, 1)
COPIES = 3
SEED = 20


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """``source, queue, source_size, n_rows, target`` of each source, in windows over one row per source.

    Sources are filled like vessels of height ``copies * size / weight`` from one level. Sorted by height, a vessel is
    full if the level that all vessels from it on would share is not below its height; the first that is not full sets
    the level of the rest.
    """
    queue = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("queue", F.lit(len(weights))) + 1).cast("int"))
    by_height = Window.orderBy("height", "queue")
    lower = by_height.rowsBetween(Window.unboundedPreceding, -1)
    upper = by_height.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("queue").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("full").over(lower), F.lit(0))) / F.sum("weight").over(upper)
    return (
        sizes.withColumn("queue", queue)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("full", F.col("source_size") * copies)
        .withColumn("height", F.col("full") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("level", level)
        .withColumn("at", F.row_number().over(by_height))
        .withColumn("first", F.min(F.when(F.col("height") > F.col("level"), F.struct("at", "level"))).over(whole))
        .select(
            "source",
            "queue",
            "source_size",
            "n_rows",
            F.when(F.col("at") >= F.col("first.at"), F.col("weight") * F.col("first.level"))
            .otherwise(F.col("full").cast("double"))
            .alias("target"),
        )
    )


def queued(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with ``queue, source_size, target`` and ``sent``: words of the source up to and with all the row's times."""
    ranges = F.ceil(F.sqrt("n_rows"))
    fraction = F.shiftrightunsigned(F.col("place"), 11) / F.lit(float(1 << 53))
    words = F.col("size") * F.col("times")
    ranged = (
        rows.join(measured(sources), rows["source"].eqNullSafe(sources["source"]))
        .drop("source")
        .withColumn("range", F.floor(fraction * ranges))
    )
    totals = written(ranged.groupBy("queue", "range").agg(F.sum(words).alias("words")), "mix-ranges")
    before = Window.partitionBy("queue").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("queue", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    upto = Window.partitionBy("queue", "range").orderBy("place").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        ranged.withColumn("inside", F.sum(words).over(upto))
        .join(measured(starts, totals.count()), ["queue", "range"])
        .withColumn("sent", F.col("start") + F.col("inside"))
        .drop("range", "start", "inside", "n_rows")
    )


def finish_time(copy: Column | int, nth: Column) -> Column:
    """When the ``nth`` of a row's times is sent, in a copy of its source's documents."""
    sent = F.col("sent") + (nth - F.col("times")) * F.col("size")
    return (sent + copy * F.col("source_size")) / F.col("target")


def sent_at(copy: Column | int, time: Column) -> Column:
    """How many of a row's times are sent by then, but for the rounding of its finish times."""
    start = F.col("sent") - F.col("times") * F.col("size") + copy * F.col("source_size")
    return F.greatest(F.lit(0), F.least(F.col("times"), F.floor((time * F.col("target") - start) / F.col("size"))))


def exploded(df: DataFrame, name: str, first: Column, last: Column, step: int = 10_000) -> DataFrame:
    """``df`` once for each whole number from ``first`` to ``last``, without an array of them all."""
    pieces = df.withColumn(name, F.explode(F.sequence(first, last, F.lit(step).cast("bigint"))))
    return pieces.withColumn(name, F.explode(F.sequence(F.col(name), F.least(last, F.col(name) + (step - 1)))))


def last_finish(rows: DataFrame, sources: DataFrame, copies: int = COPIES) -> float:
    """The largest finish time up to which the copies of all sources together stay within the budget."""
    known = sources.agg(F.sum("target").alias("budget"), F.sum("n_rows").alias("n")).first()
    if not known["budget"]:
        return 0.0
    budget = known["budget"] * (1 + 1e-12)
    ranges = math.ceil(math.sqrt(known["n"]))
    # Words are even over virtual time up to 1; beyond, sources with little weight trail far, so ranges widen.
    range_of = lambda t: F.floor(F.when(t <= 1, t).otherwise(1 + F.log(t)) * ranges)
    span = F.col("range") / ranges
    begin = F.when(span <= 1, span).otherwise(F.exp(span - 1))
    copy = F.explode(F.array(*map(F.lit, range(copies)))).alias("copy")
    sent = rows.filter("size > 0").select("size", "times", "sent", "source_size", "target", copy)
    sent = sent.withColumn("first", range_of(finish_time(F.col("copy"), F.lit(1))))
    sent = sent.withColumn("final", range_of(finish_time(F.col("copy"), F.col("times"))))
    end = (span * ranges + 1) / ranges
    end = F.when(end <= 1, end).otherwise(F.exp(end - 1))
    ranged = (
        sent.withColumn("range", F.explode(F.sequence("first", "final")))
        .withColumn("low", F.when(F.col("range") == F.col("first"), 0).otherwise(sent_at(F.col("copy"), begin)))
        .withColumn("high", F.when(F.col("range") == F.col("final"), F.col("times")).otherwise(sent_at(F.col("copy"), end)))
        .filter("high > low")
    )
    over = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (
        ranged.groupBy("range")
        .agg(
            F.sum((F.col("high") - F.col("low")) * F.col("size")).alias("words"),
            F.max(finish_time(F.col("copy"), F.col("high"))).alias("last"),
        )
        .withColumn("upto", F.sum("words").over(over))
        .agg(
            F.max(F.when(F.col("upto") <= budget, F.col("last"))).alias("last"),
            F.min(F.when(F.col("upto") > budget, F.struct("range", F.col("upto") - F.col("words")))).alias("cut"),
        )
        .first()
    )
    if edge["cut"] is None:
        return edge["last"]
    cut, start = edge["cut"]
    inside = Window.partitionBy("range").orderBy("finish").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        exploded(ranged.filter(F.col("range") == cut), "nth", F.col("low") + 1, F.col("high"))
        .select("range", "size", finish_time(F.col("copy"), F.col("nth")).alias("finish"))
        .withColumn("upto", F.sum("size").over(inside) + start)
        .filter(F.col("upto") <= budget)
        .agg(F.max("finish").alias("last"))
        .first()["last"]
    )
    return last if last is not None else edge["last"] or 0.0


def planned(docs: DataFrame, weights: Sequence[int] = WEIGHTS, copies: int = COPIES, seed: int = SEED) -> DataFrame:
    """``doc_id, place, size, times, queue, source_size, target, sent, takes``, equal rows once.

    ``takes`` says for each copy how many of the row's times are in the mix; later copies never have more.
    """
    each = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(text_or_empty()).alias("size"),
        place(seed).alias("place"),
    )
    rows = written(each.groupBy("doc_id", "source", "size", "place").agg(F.count(F.lit(1)).alias("times")), "mix-rows")
    words = F.sum(F.col("size") * F.col("times"))
    sizes = rows.groupBy("source").agg(words.alias("source_size"), F.sum("times").alias("n_rows"))
    sources = written(targets(sizes, weights, copies), "mix-sources")
    found = written(queued(rows, sources), "mix-queues")
    last = F.lit(last_finish(found, sources, copies))

    def taken(copy: int) -> Column:
        n = sent_at(copy, last)
        more = (n < F.col("times")) & (finish_time(copy, n + 1) <= last)
        fewer = (n > 0) & (finish_time(copy, n) > last)
        return F.when(F.col("size") > 0, n + more.cast("int") - fewer.cast("int")).otherwise(0).cast("bigint")

    return found.withColumn("takes", F.array(*map(taken, range(copies))))


def schedule(docs: DataFrame, weights: Sequence[int] = WEIGHTS, copies: int = COPIES, seed: int = SEED) -> DataFrame:
    """``doc_id, place, size, queue, source_size, target, sent, copies``, one row per document.

    Equal rows are dealt out in pieces of at most the root of their number, for another task each.
    """
    plan = planned(docs, weights, copies, seed)
    upper = [F.col("times"), *(F.col("takes")[c] for c in range(copies))]
    lower = [*upper[1:], F.lit(0).cast("bigint")]
    classes = [F.struct(F.lit(k).alias("copies"), (u - v).alias("n")) for k, (u, v) in enumerate(zip(upper, lower, strict=True))]
    dealt = plan.withColumn("class", F.explode(F.array(*classes))).filter("class.n > 0")
    dealt = dealt.withColumn("step", F.ceil(F.sqrt("class.n")))
    dealt = dealt.withColumn("piece", F.explode(F.expr("sequence(0, class.n - 1, step)")))
    each = dealt.repartition("place", "piece").withColumn(
        "nth", F.explode(F.expr("sequence(piece, least(piece + step, class.n) - 1)"))
    )
    return each.select("doc_id", "place", "size", "queue", "source_size", "target", "sent", "class.copies")


def place(seed: int) -> Column:
    """The shuffle's hash of a row. Rows equal in id, source and text have the same."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source").cast("string"), F.col("text").cast("string"))


def mixed(docs: DataFrame) -> DataFrame:
    """Per document what the mix takes of it: ``doc_id, size, source_size, target, taken``."""
    return schedule(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, columns unchanged."""
    key, plan, copy = free(docs, "place_"), free(docs, "plan_"), free(docs, "copy_")
    plans = planned(docs, seed=seed).filter(F.col("takes")[0] > 0)
    plans = written(
        plans.groupBy(F.col("place").alias(key)).agg(F.max(F.struct("takes", "times")).alias(plan)), "mix-copies"
    )
    met = docs.withColumn(key, place(seed)).join(measured(plans), key)
    takes, times = F.col(plan)["takes"], F.col(plan)["times"]
    in_part = F.exists(takes, lambda n: (n > 0) & (n < times))
    rows = met.withColumn(copy, F.size(F.filter(takes, lambda n: n == times)))
    # Only where the budget ends, and a copy's end, are some of several equal rows taken: they alone are numbered.
    if plans.filter(in_part).first():
        numbered = numbered_rows(met.filter(in_part), key)
        some = numbered.withColumn(copy, F.size(F.filter(takes, lambda n: n >= F.col(numbered.columns[-1]))))
        rows = rows.filter(~in_part).unionByName(some.select(*rows.columns))
    taken = rows.filter(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
    return taken.select(*columns_of(docs))


def numbered_rows(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` numbered from 1 within ``key``, in a last column; a key's rows are never in one task."""
    at, part, nth = (free(rows, c) for c in ("at_", "part_", "nth_"))
    found = rows.withColumn(at, F.monotonically_increasing_id())
    found = written(found.withColumn(part, F.shiftright(at, 33)), "mix-numbered")
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("count").over(before), F.lit(0)).alias(nth)
    starts = found.groupBy(key, part).count().select(key, part, start)
    inside = F.row_number().over(Window.partitionBy(key, part).orderBy(at))
    return found.withColumn(at, inside).join(starts, [key, part]).withColumn(nth, F.col(nth) + F.col(at)).select(*rows.columns, nth)
