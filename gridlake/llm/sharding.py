"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``arcs`` equal arcs. A document lies in the arc of its hash; an arc belongs to the next virtual
node clockwise. Arcs are dealt largest first; one whose shard would pass ``(1 + slack)`` of the mean load continues
clockwise to the next virtual node of a shard with room. If no shard has room (an arc larger than every gap, as in tiny
tables), it goes to the least loaded one. Only the arcs' sums, a fixed number set by ``arcs``, reach the driver.

Rows equal in id and text are one key, counted once. A key with more bytes than the slack of a shard is cut into pieces
of at most that and of ``PIECE`` rows, or of one row, each with an arc of its own, so that repeated rows fill no shard.

A slot is the place of a document in its shard: rows before its arc, rows before its piece there, and its number in the
piece, so that no task ever numbers a whole shard or a whole key.

Defined cases: a null text has size 1 and the checksum of the empty text; a text of any length is hashed whole; null or repeated doc_ids are spread by the
hash of id and text; the rows of a piece have successive slots in any order; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import text_or_empty, written

ARCS = 1 << 15
VIRTUAL_NODES = 256
SLACK = 0.001
# Rows of a piece at most, which one task lists.
PIECE = 100_000


def ring(shards: Iterable[int], virtual_nodes: int = VIRTUAL_NODES, arcs: int = ARCS) -> list[tuple[int, int]]:
    """Virtual nodes as (arc, shard), clockwise. A shard's nodes do not depend on the other shards."""
    return sorted(
        (xxhash.xxh64_intdigest(f"{shard}/{node}") % arcs, shard) for shard in shards for node in range(virtual_nodes)
    )


def place(
    loads: dict[int, int], shards: Iterable[int], slack: float = SLACK, virtual_nodes: int = VIRTUAL_NODES,
    arcs: int = ARCS,
) -> dict[int, int]:
    """Shard of every arc in ``loads`` (arc to bytes)."""
    shards = list(shards)
    nodes = ring(shards, virtual_nodes, arcs)
    positions = [p for p, _ in nodes]
    held = dict.fromkeys(shards, 0)
    most = (1 + slack) * sum(loads.values()) / len(shards)
    owner = {}
    for arc, size in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        first = bisect.bisect_left(positions, arc)
        tried: set[int] = set()
        for step in range(len(nodes)):
            shard = nodes[(first + step) % len(nodes)][1]
            if shard in tried:
                continue
            if held[shard] + size <= most:
                break
            tried.add(shard)
            if len(tried) == len(shards):
                shard = min(shards, key=lambda s: (held[s], s))
                break
        held[shard] += size
        owner[arc] = shard
    return owner


def arc_of(key: list[Column], arcs: int = ARCS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(arcs)).cast("int")


def assign(docs: DataFrame, shards: int = 8, slack: float = SLACK) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is ``bytes``: sizes are near equal."""
    text = text_or_empty().cast("binary")
    keys = written(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            arc_of([F.col("doc_id"), F.col("text")]).alias("arc"),
        )
        .groupBy("doc_id", "size", "text_crc32", "arc")
        .agg(F.count(F.lit(1)).alias("n")),
        "shard-keys",
    )
    room = int(slack * (keys.agg(F.sum(F.col("size") * F.col("n"))).first()[0] or 0) / shards)
    most = F.least(F.greatest(F.floor(F.lit(room) / F.col("size")), F.lit(1)), F.lit(PIECE))
    # The first piece stays in the arc of its key.
    elsewhere = arc_of([F.col("doc_id"), F.col("text_crc32"), F.col("size"), F.col("piece")])
    pieces = written(
        keys.withColumn("most", most)
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.col("most")))))
        .withColumn("n", F.least(F.col("most"), F.col("n") - F.col("piece") * F.col("most")))
        .withColumn("arc", F.when(F.col("piece") == 0, F.col("arc")).otherwise(elsewhere))
        .drop("most"),
        "shard-pieces",
    )
    totals = pieces.groupBy("arc").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.sum("n").alias("n")).collect()
    owner = place({r["arc"]: r["size"] for r in totals}, range(shards), slack)
    counts = {r["arc"]: r["n"] for r in totals}
    shard_of, before = np.zeros(ARCS, int), np.zeros(ARCS, np.int64)
    filled = [0] * shards
    for arc in sorted(owner):
        shard_of[arc], before[arc] = owner[arc], filled[owner[arc]]
        filled[owner[arc]] += counts[arc]
    spark = docs.sparkSession
    arcs = spark.createDataFrame(
        [(a, int(shard_of[a]), int(before[a])) for a in sorted(owner)], "arc int, shard int, before bigint"
    )
    upto = Window.partitionBy("arc").orderBy("doc_id", "text_crc32", "size", "piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        pieces.withColumn("start", F.sum("n").over(upto) - F.col("n"))
        .join(F.broadcast(arcs), "arc")
        .withColumn("number", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("before") + F.col("start") + F.col("number")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
