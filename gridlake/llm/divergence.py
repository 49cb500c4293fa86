"""Divergence between the sources of a language, over run-length columns.

Each language keeps the terms found in at least ``LEAST`` of its documents. A group is a language's source, and gives every
kept term a smoothed share p, in parts of 10^9. Two groups of a language differ by the sum of abs(p - q) over all kept terms.

1. Terms are counted by language and source inside tasks, then in one aggregate.
2. A language's vocabulary is reordered by the shares in its ``SORTED`` largest groups, the least of them first, so that
   terms of equal counts, above all of none, lie together. It is cut into blocks of at most ``BLOCK`` terms.
3. A group is one run-length column to a block: where a run of equal shares begins, and the share. Terms that a group lacks
   are runs too, which no row ever stands for.
4. Two columns meet at the union of their run boundaries: abs(p - q) is taken once per stretch, times its length. Groups meet
   in tiles of ``TILE`` by ``TILE``, so that a task holds two tiles of one block, however many sources there are.

Defined cases: null text, lang or source is the empty one; each row is a document, whatever its doc_id; texts without a term
and groups without a kept term have a count of 0 everywhere; a language without kept terms has distances of 0; a language of
one source has no pairs; equal values are ranked by item, in the order of its bytes; texts of any length are read whole; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import A_TO_Z, LOWER, small_batches, staged, text_or_empty, written

LEAST = 30
SMOOTHING = 5
TOP = 50
SORTED = 8
BLOCK = 4096
TILE = 64
# Terms that a task counts before it sends them.
HELD = 200_000

_OTHER = bytes(i for i in range(128) if not chr(i).isalpha())
_TERMS = bytes.maketrans(_OTHER + A_TO_Z.encode(), b" " * len(_OTHER) + LOWER.encode())


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and of anything beyond ASCII, with A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_TERMS).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, docs) in held.items():
            n = len(times)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(list(times), pa.string()),
                    pa.array(list(times.values()), pa.int64()),
                    pa.array([docs[t] for t in times], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(times)
            found = terms_of(text)
            times.update(found)
            docs.update(set(found))
            size += len(times) - before
            if size >= HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share in parts of 10^9, rounded down, and 1 more."""
    whole = F.lit(1_000_000_000).cast("decimal(10,0)") * (n + SMOOTHING).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", whole, (total + SMOOTHING * terms).cast("decimal(20,0)"))


def _columns(
    batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]],
) -> Iterator[pa.Array]:
    """Run-length columns of the places ``low`` to ``high``: those of ``cells`` have a share, all others ``none``."""
    for lows, highs, nones, cells in batches:
        rows = []
        for low, high, none, found in zip(*(x.to_pylist() for x in (lows, highs, nones, cells)), strict=True):
            column = np.full(high - low + 1, none, np.int64)
            for cell in found or ():
                column[cell["place"] - low] = cell["p"]
            starts = np.flatnonzero(np.diff(column, prepend=-1))
            rows.append({"starts": starts.tolist(), "shares": column[starts].tolist()})
        yield pa.array(rows, pa.struct([("starts", pa.list_(pa.int32())), ("shares", pa.list_(pa.int64()))]))


def distance(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """Sum of abs(p - q) over ``size`` places of two run-length columns."""
    bounds = np.union1d(a[0], b[0])
    runs = np.diff(np.append(bounds, size))
    p, q = (x[1][np.searchsorted(x[0], bounds, side="right") - 1] for x in (a, b))
    return int(np.sum(np.abs(p - q) * runs))


def _tile(found: pa.Table) -> pa.Table:
    """Distances within one block between the groups of one tile and those of another, or among those of one."""
    rows = sorted(found.to_pylist(), key=lambda r: r["number"])
    columns = [(np.array(r["starts"], np.int64), np.array(r["shares"], np.int64)) for r in rows]
    same = rows[0]["tile_a"] == rows[0]["tile_b"]
    out = []
    for i, a in enumerate(rows):
        for j in range(i + 1, len(rows)):
            b = rows[j]
            if same or a["number"] // TILE != b["number"] // TILE:
                value = distance(columns[i], columns[j], a["size"]) if a["size"] else 0
                out.append((a["lang"], a["source"], b["source"], value))
    types = [pa.string(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*out, strict=True)) or [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "source", "item", "value"])


class Counted:
    """Groups, kept terms and their counts, as tables that live as long as ``stack``."""

    def __init__(self, docs: DataFrame, least: int, stack: ExitStack):
        keep = lambda df, name: stack.enter_context(staged(df, f"divergence-{name}"))
        empty = [text_or_empty(c).alias(c) for c in ("lang", "source", "text")]
        texts = docs.select(*empty)
        raw = texts.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
        both = [F.sum(c).alias(c) for c in ("n", "docs")]
        counts = keep(raw.groupBy("lang", "source", "term").agg(*both), "counts")
        enough = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
        self.terms = keep(enough.filter(F.col("docs") >= least).select("lang", "term", "all"), "terms")
        cells = counts.filter("n > 0").select("lang", "source", "term", "n").join(self.terms.select("lang", "term"), ["lang", "term"])
        cells = keep(cells, "cells")
        langs = self.terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all").alias("lang_n"))
        sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
        by_size = Window.partitionBy("lang").orderBy(F.col("group_n").desc(), "source")
        groups = (
            texts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
            .fillna(0, ["group_n", "v", "lang_n"])
            .withColumn("number", F.row_number().over(by_size) - 1)
            .withColumn("tiles", F.floor(F.max("number").over(Window.partitionBy("lang")) / F.lit(TILE)).cast("int"))
        )
        self.groups = keep(groups, "groups")
        shared = share(F.col("n"), F.col("group_n"), F.col("v"))
        known = self.groups.select("lang", "source", "number", "group_n", "v")
        self.cells = keep(
            cells.join(known, ["lang", "source"]).select("lang", "source", "term", "number", shared.alias("p")), "shares"
        )


def vocabulary(cells: DataFrame, terms: DataFrame, block: int) -> DataFrame:
    """``lang, term, block, place``: terms in an order that puts equal counts together."""
    ranked = [F.max(F.when(F.col("number") == k, F.col("p"))).alias(f"p{k}") for k in reversed(range(SORTED))]
    order = ["lang", *(f"p{k}" for k in reversed(range(SORTED))), "all", "term"]
    sorted_ = cells.groupBy("lang", "term").agg(*ranked).join(terms, ["lang", "term"])
    placed = sorted_.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return placed.select("lang", "term", at.alias("place")).select(
        "lang", "term", F.floor(F.col("place") / F.lit(block)).alias("block"), (F.col("place") % block).cast("int").alias("place")
    )


def run_length_columns(counted: Counted, block: int, stack: ExitStack) -> DataFrame:
    """``lang, block, source, number, tiles, size, starts, shares``: every group's column of every block."""
    words = stack.enter_context(staged(vocabulary(counted.cells, counted.terms, block), "divergence-vocabulary"))
    cell = F.collect_list(F.struct("place", "p")).alias("cells")
    cells = counted.cells.join(words, ["lang", "term"]).groupBy("lang", "block", "source").agg(cell)
    blocks = words.groupBy("lang", "block").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    every = counted.groups.join(blocks, "lang", "left").select(
        "lang", "source", "number", "tiles", F.coalesce("block", F.lit(-1)).alias("block"),
        F.coalesce("low", F.lit(0)).alias("low"), F.coalesce("high", F.lit(-1)).alias("high"),
        F.when(F.col("v") > 0, share(F.lit(0), F.col("group_n"), F.col("v"))).otherwise(0).alias("none"),
    )
    made = F.arrow_udf(_columns, "starts array<int>, shares array<bigint>")("low", "high", "none", "cells")
    columns = every.join(cells, ["lang", "block", "source"], "left").withColumn("column", made)
    size = (F.col("high") - F.col("low") + 1).alias("size")
    columns = columns.select("lang", "block", "source", "number", "tiles", size, "column.starts", "column.shares")
    return stack.enter_context(staged(columns, "divergence-columns"))


def distances(columns: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language, both ways."""
    own = F.floor(F.col("number") / F.lit(TILE)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles")))
    dealt = (
        columns.select("*", own.alias("own"), other.alias("other"))
        .withColumn("tile_a", F.least("own", "other"))
        .withColumn("tile_b", F.greatest("own", "other"))
        .drop("own", "other", "tiles")
    )
    met = dealt.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(
        _tile, "lang string, source string, item string, value bigint"
    )
    one_way = met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    return one_way.select("lang", "value", F.explode(ways).alias("way")).select("lang", "way.source", "way.item", "value")


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by distance, and the terms a source has in excess."""
    small_batches(docs)
    with ExitStack() as stack:
        counted = Counted(docs, least, stack)
        pairs = ranked(distances(run_length_columns(counted, block, stack)), "pair")
        langs = counted.groups.groupBy("lang").agg(F.max("v").alias("v"), F.max("lang_n").alias("lang_n"))
        whole = counted.terms.join(langs, "lang").select(
            "lang", "term", share(F.col("all"), F.col("lang_n"), F.col("v")).alias("q")
        )
        excess = counted.cells.join(whole, ["lang", "term"]).filter("p > q")
        excess = excess.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        terms = ranked(excess, "term").filter(F.col("rank") <= top)
        return written(pairs.unionByName(terms), "divergence")
