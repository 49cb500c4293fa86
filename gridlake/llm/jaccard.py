"""Similarity join on five-word shingles: Jaccard of 0.8 or more, with Bayesian pruning of candidates.

1. One pass over the texts gives each a digest and ``HASHES`` MinHash values. Equal texts become one node.
2. Nodes that agree in a band of three values share a bucket (21 bands: a pair at 0.8 meets in none with probability
   3e-7). Buckets with the same members are compared once, large ones in blocks of bounded size.
3. Pairs of a bucket compare their MinHash values eight at a time. After each step the posterior probability that the
   similarity reaches the threshold, given the matches so far and a uniform prior, decides: below ``TOLERANCE`` the pair
   is dropped. What is left connects nodes to candidate groups. Only a spanning star per bucket leaves a task.
4. Inside a candidate group every pair is verified exactly on its shingles, again in blocks of bounded size. A task
   returns per node the number of its links and one edge, so that no pair is ever a row.
5. The verified edges' components are the classes.

Words are runs without ASCII white space, compared as they are; shingles are 64-bit hashes of five successive words. A
text with one to four words is one shingle.

Defined cases: a null text or one without words is similar to nothing and a class of its own; repeated rows are copies
of each other; a null doc_id sorts last, and such a row's class is the smallest id linked to it, else null; an empty
table gives no rows. Extra columns are not read by ``classes`` and stay as they are in ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import BROADCAST_ROWS, columns_of, free, measured, small_batches, text_or_empty, written
from gridlake.llm.components import components

SHINGLE = 5
THRESHOLD = (4, 5)
HASHES = 64
BAND = 3
STEP = 8
TOLERANCE = 1e-6
BLOCK = 512
BLOCK_WORDS = 1_000_000
SLICE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WORD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, words)``: shingle hashes of all texts in order, where each text's begin, and its word count.

    All texts are hashed at once: a word's hash is the difference of two running sums of byte times power.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    begin, end = edge[::2], edge[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw)), out=sums[1:])
    word = _mixed((sums[end] - sums[begin]) * _powers(_BACK, len(raw) + 1)[begin])
    text_end = np.cumsum(lengths)
    first = np.searchsorted(begin, text_end - lengths)
    words = np.searchsorted(begin, text_end) - first
    count = np.maximum(words - SHINGLE + 1, (words > 0).astype(words.dtype))
    starts = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(starts[-1]) + np.repeat(first - starts[:-1], count)
    left = np.repeat(first + words, count) - at
    hashes = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        # Beyond the end of a short text a fixed value stands for no word.
        part = word[np.minimum(at + k, max(len(word) - 1, 0))] if len(word) else hashes
        hashes = hashes * _WORD + np.where(left > k, part, np.uint64(0))
    return _mixed(hashes), starts, words


def minhashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row of ``HASHES`` values per text, and the texts' word counts."""
    hashes, starts, words = shingles(texts)
    out = np.zeros((len(texts), HASHES), np.uint32)
    full = np.flatnonzero(words > 0)
    if len(full):
        for k in range(HASHES):
            values = (hashes * _FACTORS[k]) >> np.uint64(32)
            out[full, k] = np.minimum.reduceat(values, starts[full])
    return out, words


def slices(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts in runs of about ``SLICE`` bytes, so that memory follows the longest text and not the batch."""
    part, size = [], 0
    for value in texts:
        raw = (value.as_py() or "").encode("utf-8", "replace")
        part.append(raw)
        size += len(raw)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _signatures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        found = [minhashes(part) for part in slices(batch)]
        rows = [row.tobytes() for values, _ in found for row in values]
        words = np.concatenate([w for _, w in found]) if found else np.zeros(0, np.int64)
        yield pa.StructArray.from_arrays([pa.array(rows, pa.binary()), pa.array(words, pa.int64())], ["values", "n_words"])


def digest(text: Column) -> Column:
    """16 bytes of the text's SHA-256: the node of all its copies."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def needed(hashes: int, threshold: float, tolerance: float) -> int:
    """Matches out of ``hashes`` from which the posterior P(similarity >= threshold) reaches the tolerance.

    With a uniform prior it is the chance of at most that many successes in ``hashes + 1`` draws at the threshold.
    """
    chance = 0.0
    for m in range(hashes + 2):
        chance += math.comb(hashes + 1, m) * threshold**m * (1 - threshold) ** (hashes + 1 - m)
        if chance >= tolerance:
            return m
    return hashes


NEEDED = [needed(n, THRESHOLD[0] / THRESHOLD[1], TOLERANCE) for n in range(HASHES + 1)]


def surviving(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that stay probable to the last MinHash value."""
    matches = np.zeros(len(a), np.int32)
    for at in range(0, HASHES, STEP):
        if not len(a):
            break
        matches += (values[a, at : at + STEP] == values[b, at : at + STEP]).sum(1, dtype=np.int32)
        keep = matches >= NEEDED[at + STEP]
        a, b, matches = a[keep], b[keep], matches[keep]
    return a, b


def smallest_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the first row that it is connected to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and their bounds, from batches in the order of ``keys``; the last group waits for more."""
    held = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        bounds = group_bounds(held, keys)
        if len(bounds) > 2:
            yield held.slice(0, bounds[-2]), bounds[:-1]
            held = held.slice(bounds[-2])
    if held is not None and held.num_rows:
        yield held, group_bounds(held, keys)


def group_bounds(rows: pa.Table, keys: list[str]) -> np.ndarray:
    if not rows.num_rows:
        return np.zeros(1, np.int64)
    new = np.zeros(rows.num_rows - 1, bool)
    for key in keys:
        column = rows[key].combine_chunks()
        new |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1, [rows.num_rows]])


def group_pairs(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All row pairs within the groups, groups of one size together, in runs of bounded length."""
    sizes = np.diff(bounds)
    for n in np.unique(sizes[sizes > 1]):
        a, b = np.triu_indices(int(n), 1)
        starts = bounds[:-1][sizes == n]
        per = max(1, (1 << 18) // len(a))
        for at in range(0, len(starts), per):
            part = starts[at : at + per, None]
            yield (part + a).ravel(), (part + b).ravel()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, bounds in whole_groups(batches, ["band", "key", "i", "j"]):
        values = np.frombuffer(b"".join(rows["values"].to_pylist()), np.uint32).reshape(-1, HASHES)
        i, j, own = (rows[c].to_numpy() for c in ("i", "j", "own"))
        across = i != j
        kept = []
        for a, b in group_pairs(bounds):
            other = ~across[a] | (own[a] != own[b])
            kept.append(surviving(values, a[other], b[other]))
        a = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in kept)])
        b = np.concatenate([np.zeros(0, np.int64), *(x for _, x in kept)])
        label = smallest_labels(rows.num_rows, a, b)
        moved = np.flatnonzero(label != np.arange(len(label)))
        node = rows["node"].combine_chunks()
        yield pa.RecordBatch.from_arrays([node.take(pa.array(label[moved])), node.take(pa.array(moved))], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    over, under = THRESHOLD
    for rows, _ in whole_groups(batches, ["label", "i", "j"]):
        bounds = group_bounds(rows, ["label", "i", "j"])
        node = rows["node"].combine_chunks()
        center = np.arange(rows.num_rows)
        links = np.zeros(rows.num_rows, np.int64)
        copies = rows["copies"].to_numpy()
        i, j, own = (rows[c].to_numpy() for c in ("i", "j", "own"))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            lo, hi = int(lo), int(hi)
            sets = [np.unique(shingles([t.as_py().encode("utf-8", "replace")])[0]) for t in rows["text"].slice(lo, hi - lo)]
            size = np.array([len(s) for s in sets], np.int64)
            both = shared(sets)
            similar = under * both >= over * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(similar, False)
            if i[lo] != j[lo]:
                similar &= own[lo:hi, None] != own[None, lo:hi]
            links[lo:hi] = similar @ copies[lo:hi]
            a, b = np.nonzero(np.triu(similar))
            center[lo:hi] = lo + smallest_labels(hi - lo, a, b)
        yield pa.RecordBatch.from_arrays([node, node.take(pa.array(center)), pa.array(links)], ["node", "center", "links"])


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of bounded blocks of the membership matrix."""
    n = len(sets)
    member = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = times > 1
    rank = np.cumsum(common) - 1
    keep = common[column]
    member, column = member[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    width = max(64, (1 << 21) // n)
    out = np.zeros((n, n), np.float64)
    np.fill_diagonal(out, [len(s) for s in sets])
    for at in range(0, int(common.sum()), width):
        lo, hi = np.searchsorted(column, [at, at + width])
        block = np.zeros((n, width), np.float32)
        block[member[lo:hi], column[lo:hi] - at] = 1
        product = block @ block.T
        np.fill_diagonal(product, 0)
        out += product
    return out.astype(np.int64)


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows of groups cut into ``blocks`` parts, sent to every pair ``i <= j`` of parts that holds their part ``own``."""
    return (
        rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other")
    )


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Written tables: ``doc_id, node`` per row (node null without words), and ``node, rep, copies, class, links`` of
    every node with a copy or a link; ``class`` is the smallest node of the class."""
    small_batches(docs)
    signature = F.arrow_udf(_signatures, "values binary, n_words bigint")
    rows = written(
        docs.select("doc_id", text_or_empty().alias("text"))
        .select("doc_id", digest(F.col("text")).alias("node"), signature("text").alias("s"))
        .select("doc_id", F.when(F.col("s.n_words") > 0, F.col("node")).alias("node"), "s.values", "s.n_words"),
        "jaccard-rows",
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id")
    nodes = written(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min(first)["doc_id"].alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.max("values").alias("values"),
            F.max("n_words").alias("n_words"),
        ),
        "jaccard-nodes",
    )
    width = 4 * BAND
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda k: F.struct(k.alias("band"), F.substring(F.col("values"), k * width + 1, F.lit(width)).alias("key")),
    )
    spread = nodes.select("node", F.explode(bands).alias("b")).select("node", "b.band", "b.key")
    buckets = (
        spread.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("members"))
        .filter("n > 1")
        .groupBy("n", "members")
        .agg(F.min(F.struct("band", "key")).alias("b"))
        .select("b.band", "b.key", "n")
    )
    buckets = written(buckets, "jaccard-buckets")
    met = nodes.select("node", "values", F.explode(bands).alias("b")).select("node", "values", "b.band", "b.key")
    pairs = in_blocks(met.join(measured(buckets), ["band", "key"]), F.ceil(F.col("n") / BLOCK))
    stars = (
        pairs.select("band", "key", "i", "j", "own", "node", "values")
        .repartition("band", "key", "i", "j")
        .sortWithinPartitions("band", "key", "i", "j", "node")
        .mapInArrow(_compare, "a binary, b binary")
    )
    groups = components(stars)
    known = nodes.select("node", "rep", "copies", "n_words")
    members = groups.join(known, "node")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("words") / BLOCK_WORDS)).alias("blocks")
    members = written(members.join(sizes.select("label", blocks), "label"), "jaccard-members")
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("node", digest(F.col("text")))
    # One row per node: a repeated row brings its text again. The members' rows alone are reduced if they are found by a
    # broadcast, else all rows, before the join deals them out by node.
    n_members = members.count()
    if n_members > BROADCAST_ROWS:
        texts = texts.groupBy("node", "doc_id").agg(F.any_value("text").alias("text"))
    d, m = texts.alias("d"), measured(members, n_members).alias("m")
    found = d.join(m, (F.col("d.node") == F.col("m.node")) & F.col("d.doc_id").eqNullSafe(F.col("m.rep"))).select(
        "d.text", "m.node", "m.label", "m.copies", "m.blocks"
    )
    if n_members <= BROADCAST_ROWS:
        found = found.groupBy("node", "label", "copies", "blocks").agg(F.any_value("text").alias("text"))
    checked = written(
        in_blocks(found, F.col("blocks"))
        .select("label", "i", "j", "own", "node", "copies", "text")
        .repartition("label", "i", "j")
        .sortWithinPartitions("label", "i", "j", "node")
        .mapInArrow(_verify, "node binary, center binary, links bigint"),
        "jaccard-links",
    )
    classes = components(checked.filter("links > 0").select(F.col("node").alias("a"), F.col("center").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    info = (
        known.drop("n_words")
        .join(links, "node", "left")
        .filter("copies > 1 or links > 0")
        .join(classes, "node", "left")
        .select("node", "rep", "copies", F.coalesce("label", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    return rows.select("doc_id", "node"), written(info, "jaccard-classes")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links``: the smallest doc_id of the class, and how many other rows are similar."""
    rows, info = linked(docs)
    first = F.min(F.struct(F.col("rep").isNull(), "rep"))["rep"]
    names = info.groupBy("class").agg(first.alias("class_id"))
    named = written(
        info.join(names, "class").select("node", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")),
        "jaccard-named",
    )
    return rows.join(measured(named), "node", "left").select(
        "doc_id",
        F.when(F.col("n_links").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest doc_id; columns unchanged."""
    rows, info = linked(docs)
    best = F.min(F.struct(F.col("rep").isNull(), "rep", "node"))
    winners = info.groupBy("class").agg(best.alias("w")).select(F.col("w.node").alias("node"), F.col("w.rep").alias("rep"))
    held = rows.join(measured(info.select("node"), info.count()), "node").withColumnRenamed("doc_id", "id")
    met = F.col("w.node").eqNullSafe(F.col("h.node")) & F.col("w.rep").eqNullSafe(F.col("h.id"))
    counted = held.groupBy("node", "id").agg(F.count(F.lit(1)).alias("times")).alias("h")
    # Names that the documents do not have, as their columns go through these joins.
    node, id_, wins = free(docs, "node_"), free(docs, "id_"), free(docs, "wins_")
    fates = counted.join(winners.alias("w"), met, "left").select(
        F.col("h.node").alias(node), F.col("h.id").alias(id_), "times", F.col("w.node").isNotNull().alias(wins)
    )
    gone = written(fates.filter(~F.col(wins) | (F.col("times") > 1)).drop("times"), "jaccard-gone")
    same = F.col(id_).eqNullSafe(F.col("doc_id")) & (F.col(node) == digest(text_or_empty()))
    kept = docs.join(measured(gone), same, "left_anti")
    twice = gone.filter(wins)
    if twice.isEmpty():
        return kept
    # A winner whose row is repeated: one of them, whichever comes first.
    again = docs.join(measured(twice), same).groupBy(id_, node).agg(F.first(F.struct(*columns_of(docs))).alias("row"))
    return kept.unionByName(again.select(*(F.col(f"row.`{c}`") for c in docs.columns)))
