"""Benchmark decontamination by suffix arrays of the training text.

Each task cuts its documents into shards of about ``SHARD_BYTES`` (a longer document is a shard of its own) and builds a
word suffix array of each shard. Every suffix of every benchmark item is binary-searched in it, which gives its longest
verbatim match and the run of training positions that hold its window. Shards live only inside a task; a lost executor
costs a rerun of its tasks.

Only positions from which a window's worth of benchmark words follow can begin a match, so only these are sorted.
The benchmark is a stated query set: it is sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one pass over
the documents per block, so that what is broadcast is bounded. One block holds some two million words.

Words are runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased. A window is ``WINDOW`` successive
words of an item, or a whole shorter item.

Defined cases: null or empty texts have no words, match nothing and are clean; a null item_id takes part in matches but
not in ``items``; repeated items count once; repeated documents are judged each on its own; an empty benchmark leaves
all documents clean; extra columns are not read by ``matches`` and stay in ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import columns_of, free, item_words, small_batches, text_or_empty

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20

FOUND = pa.struct(
    [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit", pa.binary()), ("items", pa.list_(pa.string())),
        ("longest", pa.int64()), ("longest_item", pa.string()), ("longest_at", pa.int64()), ("longest_from", pa.int64()),
    ]
)
LONGEST = ("longest", "longest_item", "longest_at", "longest_from")
SCHEMA = (
    "n_words bigint, n_hit bigint, hit binary, items array<string>, longest bigint, longest_item string, "
    "longest_at bigint, longest_from bigint"
)


class Benchmark:
    """The words of a block of items, numbered and each item ended by a zero, and the suffixes that are searched."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        words = [(str(i) if i is not None else None, item_words(text)) for i, text in items]
        words = [(i, w) for i, w in words if w]
        self.window = window
        self.ids = [i for i, _ in words]
        self.number = {w: n for n, w in enumerate(sorted({x for _, ws in words for x in ws}), 1)}
        self.flat = np.fromiter((n for _, ws in words for n in (*map(self.number.get, ws), 0)), np.int32)
        lengths = np.array([len(w) for _, w in words], np.int64)
        start = np.cumsum(lengths + 1) - (lengths + 1)
        # A suffix is searched if a whole window fits in it, or if it is a short item from its first word.
        need = np.minimum(lengths, window)
        count = lengths - need + 1
        self.item = np.repeat(np.arange(len(words)), count)
        self.offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        self.at = start[self.item] + self.offset
        self.need = need[self.item]
        self.least = int(need.min()) if len(need) else window


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` sorted by the words from there on, compared to ``depth`` words, by doubling ranks."""
    rank = words.astype(np.int64)
    width = 1
    while width < depth:
        ahead = np.zeros_like(rank)
        ahead[:-width] = rank[width:]
        _, rank = np.unique((rank << 32) | ahead, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        width *= 2
        if len(np.unique(rank[starts])) == len(starts):
            break
    return starts[np.argsort(rank[starts], kind="stable")]


def search(words: np.ndarray, array: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """For each benchmark suffix the run ``[low, high)`` of the suffix array that starts with its window."""
    bounds = []
    for beyond in (False, True):
        low = np.zeros(len(bench.at), np.int64)
        high = np.full(len(bench.at), len(array), np.int64)
        live = np.arange(len(bench.at))
        while len(live):
            middle = (low[live] + high[live]) // 2
            order = compare(words, array[middle], bench, live)
            right = (order < 0) | (beyond & (order == 0))
            low[live[right]] = middle[right] + 1
            high[live[~right]] = middle[~right]
            live = live[low[live] < high[live]]
        bounds.append(low)
    return bounds[0], bounds[1]


def compare(words: np.ndarray, at: np.ndarray, bench: Benchmark, suffix: np.ndarray) -> np.ndarray:
    """-1, 0 or 1: how the training words at ``at`` stand to the suffix's window."""
    order = np.zeros(len(at), np.int8)
    live = np.arange(len(at))
    for k in range(bench.window):
        live = live[bench.need[suffix[live]] > k]
        train = words[np.minimum(at[live] + k, len(words) - 1)]
        test = bench.flat[bench.at[suffix[live]] + k]
        order[live] = np.sign(train - test)
        live = live[train == test]
    return order


def agreement(words: np.ndarray, at: np.ndarray, bench: Benchmark, suffix: np.ndarray) -> np.ndarray:
    """How many words agree from there on; a zero ends every document, unknown word and item."""
    length = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        train = words[at[live] + length[live]]
        same = (train == bench.flat[bench.at[suffix[live]] + length[live]]) & (train > 0)
        live = live[same]
        length[live] += 1
    return length


def occurrences(words: np.ndarray, starts: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(suffix, position, length)`` of every place where a benchmark suffix matches by its window or more."""
    array = suffix_array(words, starts, bench.window)
    low, high = search(words, array, bench)
    found = high - low
    suffix = np.repeat(np.arange(len(found)), found)
    at = array[np.arange(int(found.sum())) - np.repeat(np.cumsum(found) - found, found) + np.repeat(low, found)]
    return suffix, at, agreement(words, at, bench, suffix)


def match_shard(texts: list[list[bytes]], bench: Benchmark) -> list[dict]:
    """One result per document of a shard."""
    n_words = np.array([len(t) for t in texts], np.int64)
    # One word of number 0 ends each document, so that no match runs over its end.
    flat = np.zeros(int(n_words.sum()) + len(texts), np.int32)
    start = np.cumsum(n_words + 1) - (n_words + 1)
    for at, words in zip(start.tolist(), texts, strict=True):
        flat[at : at + len(words)] = [bench.number.get(w, 0) for w in words]
    ends = np.flatnonzero(flat == 0)
    run = ends[np.searchsorted(ends, np.arange(len(flat)))] - np.arange(len(flat))
    out = [{"n_words": int(n), "n_hit": 0, "hit": b"", "items": [], "longest": 0} for n in n_words]
    if not len(bench.at) or not (run >= bench.least).any():
        return out
    # Only stretches of benchmark words long enough to hold a window, each with the zero that ends it.
    long = run[np.concatenate([[0], ends[:-1] + 1])] >= bench.least
    places = np.flatnonzero(np.repeat(long, np.diff(ends, prepend=-1)))
    suffix, at, length = occurrences(flat[places], np.flatnonzero(run[places] >= bench.least), bench)
    at = places[at]
    hit = np.zeros(len(flat) + 1, np.int32)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + bench.need[suffix], -1)
    covered = np.cumsum(hit[:-1]) > 0
    doc = np.searchsorted(start, at, side="right") - 1
    for pair in np.unique(doc * len(bench.ids) + bench.item[suffix]).tolist():
        item = bench.ids[pair % len(bench.ids)]
        if item is not None:
            out[pair // len(bench.ids)]["items"].append(item)
    order = np.lexsort((at, -length, doc))
    for k in order[np.unique(doc[order], return_index=True)[1]].tolist():
        d = int(doc[k])
        own = covered[start[d] : start[d] + n_words[d]]
        out[d] |= {
            "n_hit": int(own.sum()),
            "hit": np.packbits(own).tobytes(),
            "items": sorted(set(out[d]["items"])),
            "longest": int(length[k]),
            "longest_item": bench.ids[bench.item[suffix[k]]],
            "longest_at": int(at[k] - start[d]),
            "longest_from": int(bench.offset[suffix[k]]),
        }
    return out


def _shards(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for value in texts:
        words = item_words(value.as_py())
        part.append(words)
        size += sum(map(len, words)) + len(words)
        if size >= SHARD_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's items in blocks of at most ``most`` bytes (a longer item is one by itself), one after the other."""
    block: list[tuple[object, str | None]] = []
    size = 0
    for row in benchmark.select("item_id", "text").distinct().toLocalIterator():
        here = len((row["text"] or "").encode("utf-8", "replace"))
        if block and size + here > most:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += here
    yield block


def _searcher(sent: Broadcast):
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([row for part in _shards(batch) for row in match_shard(part, sent.value)], FOUND)

    return F.arrow_udf(found, SCHEMA)


def _hits_of_all(hits: list[bytes]) -> int:
    size = max(map(len, hits))
    united = np.zeros(size, np.uint8)
    for bits in hits:
        united |= np.frombuffer(bits.ljust(size, b"\0"), np.uint8)
    return int(np.unpackbits(united).sum())


def matches(docs: DataFrame, benchmark: DataFrame, into: str = "match", most: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the struct ``into``: ``n_words``, ``n_hit``, ``items``, and the longest verbatim match.

    ``longest`` is its length in words, ``longest_item`` the item, ``longest_at`` the document word and
    ``longest_from`` the item word at which it begins.
    """
    if any(c.startswith(into) for c in docs.columns):
        raise ValueError(f"columns beginning with {into} are taken")
    small_batches(docs)
    out = docs
    parts = []
    for number, items in enumerate(blocks(benchmark, most)):
        sent = docs.sparkSession.sparkContext.broadcast(Benchmark(items))
        parts.append(f"{into}{number}")
        out = out.withColumn(parts[-1], _searcher(sent)(text_or_empty()))
    best = F.col(parts[0])
    n_hit, items = best["n_hit"], best["items"]
    if len(parts) > 1:
        n_hit = F.udf(_hits_of_all, "bigint")(F.array(*(F.col(p)["hit"] for p in parts)))
        items = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.col(p)["items"] for p in parts)))))
        best = F.array_max(F.array(*(F.struct(F.col(p)["longest"], F.col(p).alias("p")) for p in parts)))["p"]
    whole = F.struct(
        F.col(parts[0])["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        items.alias("items"),
        *(best[c].alias(c) for c in LONGEST),
    )
    return out.withColumn(into, whole).drop(*parts)


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: hit words, and a digest of the items found in it."""
    m = F.col("match")
    return matches(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        m["n_words"].alias("n_words"),
        m["n_hit"].alias("n_hit"),
        F.size(m["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(m["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (m["n_hit"] > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark window, columns unchanged."""
    into = free(docs, "match")
    return matches(docs, benchmark, into).filter(F.col(into)["n_hit"] == 0).select(*columns_of(docs))
