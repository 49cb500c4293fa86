"""Substring dedup: words covered by a window of 13 words that also starts in a document with a smaller doc_id.

1. Super-k-mers are counted by slot of their minimiser, to find the slots that are too full for one part.
2. Every document's super-k-mers travel as packed strings to the part of their minimiser; a task sends equal strings once,
   with the smallest and largest doc_id that it saw. In a part, equal strings become one, the hashes of its windows are
   sorted, and windows with equal hashes are compared word for word: each window's first document is then known.
3. Super-k-mers with a window of two documents or more are joined back, by their digest, to the texts that hold them, and
   each text is cut with its own list.

A part holds what ``PART`` bytes of text send it, in distinct strings; copies, however many, are one. Windows of a crowded
slot travel alone, dealt by their own hash, so that a passage of a third of all documents has no part of its own.

Defined cases: null and empty texts have no words; so have texts of white space only; a text of fewer than 13 words loses
none; a null doc_id is the largest possible one, so that all rows without one count as one document, last in order; rows
with the same doc_id count as one document and take nothing from each other; a window repeated inside its first document
stays there; texts of any length are read whole, in overlapping pieces; an empty table gives no rows; extra columns are
not read by ``marked`` and stay in ``dedupe``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import columns_of, free, small_batches, staged, text_or_empty, written
from gridlake.llm.superkmers import BLOCK, WINDOW, pieces, runs_of, words_of

# Bytes of text that one part stands for, slots to a part, and strings that a task holds before it sends them.
PART = 4 << 20
SLOTS = 4
HELD = 100_000
LAST = (1 << 63) - 1


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts (first column) of about ``BLOCK`` bytes, with the second column's value of each."""
    texts, keys, size = [], [], 0
    for batch in batches:
        for text, key in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            for _, piece in pieces(text.as_py().encode("utf-8", "replace")):
                texts.append(piece)
                keys.append(key)
                size += len(piece)
                if size >= BLOCK:
                    yield texts, keys
                    texts, keys, size = [], [], 0
    if texts:
        yield texts, keys


def _sketch(slots: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _ in _blocks(batches):
            found, n = np.unique(runs_of(words_of(texts)).key % np.uint64(slots), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n)], ["slot", "n"])

    return sketch


def crowded_slots(texts: DataFrame, parts: int) -> np.ndarray:
    """Slots with more than two parts' share of all super-k-mers: at most one for two parts."""
    counts = texts.mapInArrow(_sketch(parts * SLOTS), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    with staged(counts, "substring-slots") as slots:
        total = slots.agg(F.sum("n")).first()[0] or 0
        full = slots.filter(F.col("n") > max(1, 2 * total / parts)).select("slot").toArrow()
    return np.sort(full.column(0).to_numpy()).astype(np.uint64)


def _send(parts: int, crowded: Broadcast, most_held: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        least, most, to = [], [], []

        def rows() -> pa.RecordBatch:
            packer = zstandard.ZstdCompressor(level=1)
            order = np.argsort(to, kind="stable")
            dealt, low, high = (np.array(x, np.int64)[order] for x in (to, least, most))
            strings = list(held)
            strings = [strings[i] for i in order.tolist()]
            edges = [0, *(np.flatnonzero(np.diff(dealt)) + 1).tolist(), len(dealt)]
            columns = [dealt[edges[:-1]].tolist(), [], [], []]
            for a, b in itertools.pairwise(edges):
                columns[1].append(packer.compress(b"\n".join(strings[a:b])))
                columns[2].append(packer.compress(np.diff(low[a:b], prepend=0).tobytes()))
                columns[3].append(packer.compress(np.diff(high[a:b], prepend=0).tobytes()))
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "strings", "least", "most"]
            )

        for texts, keys in _blocks(batches):
            words = words_of(texts)
            runs = runs_of(words, parts * SLOTS, crowded.value)
            part = (runs.key % np.uint64(parts)).tolist()
            for string, p, text in zip(runs.strings(words), part, runs.text.tolist(), strict=True):
                key = keys[text]
                at = held.setdefault(string, len(to))
                if at == len(to):
                    to.append(p)
                    least.append(key)
                    most.append(key)
                elif key < least[at]:
                    least[at] = key
                elif key > most[at]:
                    most[at] = key
            if len(held) >= most_held:
                yield rows()
                for x in (held, least, most, to):
                    x.clear()
        if held:
            yield rows()

    return send


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes], list[int], list[int]]]:
    reader = zstandard.ZstdDecompressor()
    for part, strings, least, most in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        ids = (np.cumsum(np.frombuffer(reader.decompress(x), np.int64)).tolist() for x in (least, most))
        yield part, reader.decompress(strings).split(b"\n"), *ids


def first_documents(strings: list[bytes], least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of two documents or more: the number of their string, their first document, and a bit for each place.

    One entry to a string and a first document; most strings have only one.
    """
    hashes, holder, place, windows = [], [], [], []
    at = 0
    while at < len(strings):
        upto, size = at, 0
        while upto < len(strings) and (size < BLOCK or upto == at):
            size += len(strings[upto])
            upto += 1
        words = words_of(strings[at:upto])
        n = np.diff(words.firsts) - (WINDOW - 1)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(words.firsts[:-1], n) + inside
        hashes.append(words.hashes(first, first + WINDOW))
        holder.append(np.repeat(np.arange(at, upto), n))
        place.append(inside)
        windows.append((words, first))
        at = upto
    bounds = np.cumsum([0, *map(len, hashes)])
    hashes, holder, place = (np.concatenate(x) for x in (hashes, holder, place))
    first, last = least[holder], most[holder]
    order = np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    again = np.sort(order[np.concatenate([same, [False]]) | np.concatenate([[False], same])])
    # Equal windows have equal hashes; those with equal hashes are told apart by their words.
    groups: dict[bytes, int] = {}
    group = []
    for (words, begins), low, high in zip(windows, bounds[:-1], bounds[1:], strict=True):
        begin = begins[again[np.searchsorted(again, low) : np.searchsorted(again, high)] - low]
        group += [groups.setdefault(w, len(groups)) for w in words.cut(begin, begin + WINDOW)]
    group = np.array(group, np.int64)
    low, high = np.full(len(groups), LAST, np.int64), np.full(len(groups), -LAST - 1, np.int64)
    np.minimum.at(low, group, first[again])
    np.maximum.at(high, group, last[again])
    first[again], last[again] = low[group], high[group]
    shared = np.flatnonzero(first < last)
    shared = shared[np.lexsort((first[shared], holder[shared]))]
    owner, who = holder[shared], first[shared]
    if not len(owner):
        return owner, who, owner
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(who) != 0)]))
    bits = np.bitwise_or.reduceat(np.left_shift(np.int64(1), place[shared]), edges)
    return owner[edges], who[edges], bits


def digests(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of each string's 128-bit hash."""
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, strings)), np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


SHARED = "id bigint, proof bigint, who bigint, bits bigint"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts one after the other; of each, the strings with windows of two documents."""
    packed = (x for batch in batches for x in _unpacked(batch))
    for _, blobs in itertools.groupby(packed, lambda x: x[0]):
        known: dict[bytes, int] = {}
        least, most = [], []
        for _, strings, lows, highs in blobs:
            for string, low, high in zip(strings, lows, highs, strict=True):
                at = known.setdefault(string, len(least))
                if at == len(least):
                    least.append(low)
                    most.append(high)
                else:
                    least[at], most[at] = min(low, least[at]), max(high, most[at])
        strings = list(known)
        owner, who, bits = first_documents(strings, np.array(least, np.int64), np.array(most, np.int64))
        id_, proof = digests([strings[i] for i in owner.tolist()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (id_, proof, who, bits)], ["id", "proof", "who", "bits"]
        )


def _occurrences(slots: int, crowded: Broadcast):
    """The super-k-mers of each text, once for all its copies that a task reads one after the other or nearly so."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for texts, keys in _blocks(batches):
            marks = list(map(xxhash.xxh3_128_digest, texts))
            new = [i for i, mark in enumerate(marks) if mark not in seen and not seen.add(mark)]
            words = words_of([texts[i] for i in new])
            runs = runs_of(words, slots, crowded.value)
            key = np.array([keys[i] for i in new], np.int32)[runs.text]
            id_, _ = digests(runs.strings(words))
            yield pa.RecordBatch.from_arrays([pa.array(id_, pa.int64()), pa.array(key)], ["id", "text_key"])
            if len(seen) >= HELD:
                seen.clear()

    return occurrences


KEPT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def _kept(slots: int, crowded: Broadcast):
    def covered(texts: list[bytes], keys: list[int], lists: list[pa.Array]) -> list[np.ndarray]:
        """For each text, whether each word is covered by a window that starts in a document before ``key``."""
        gone = [np.zeros(len(text.split()) + 1, np.int32) for text in texts]
        shared: list[dict[tuple[int, int], int]] = []
        for key, found in zip(keys, lists, strict=True):
            columns = [x.to_numpy(zero_copy_only=False) for x in found.flatten()]
            before = columns[2] < key
            bits: dict[tuple[int, int], int] = {}
            for id_, proof, bit in zip(*(columns[c][before].tolist() for c in (0, 1, 3)), strict=True):
                bits[id_, proof] = bits.get((id_, proof), 0) | bit
            shared.append(bits)
        cut = [(i, at, piece) for i, text in enumerate(texts) if shared[i] for at, piece in pieces(text)]
        for block in _by_size(cut):
            words = words_of([piece for _, _, piece in block])
            runs = runs_of(words, slots, crowded.value)
            id_, proof = digests(runs.strings(words))
            inside = runs.first - words.firsts[runs.text]
            for text, first, *key in zip(
                runs.text.tolist(), inside.tolist(), id_.tolist(), proof.tolist(), strict=True
            ):
                i, at, _ = block[text]
                bits = shared[i].get(tuple(key), 0) & ((1 << 64) - 1)
                while bits:
                    place = at + first + (bits & -bits).bit_length() - 1
                    gone[i][place] += 1
                    gone[i][place + WINDOW] -= 1
                    bits &= bits - 1
        return [np.cumsum(x[:-1]) > 0 for x in gone]

    def kept(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, keys, lists in batches:
            texts = [x.as_py().encode("utf-8", "replace") for x in batch]
            listed = np.flatnonzero(lists.is_valid()).tolist()
            marks = covered([texts[i] for i in listed], [keys[i].as_py() for i in listed], [lists[i].values for i in listed])
            marks = dict(zip(listed, marks, strict=True))
            rows = []
            for i, text in enumerate(texts):
                words = left = text.split()
                if i in marks:
                    left = list(itertools.compress(words, ~marks[i]))
                rows.append({
                    "n_words": len(words),
                    "n_removed": len(words) - len(left),
                    "text": b" ".join(left).decode("utf-8", "replace"),
                })
            yield pa.array(rows, KEPT)

    return F.arrow_udf(kept, "n_words bigint, n_removed bigint, text string")


def _by_size(cut: list[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Pieces in blocks of about ``BLOCK`` bytes."""
    block, size = [], 0
    for row in cut:
        block.append(row)
        size += len(row[2])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))


def shared_runs(docs: DataFrame, parts: int, crowded: Broadcast, held: int = HELD) -> DataFrame:
    """``id, proof, who, bits``: super-k-mers, the first document of windows of theirs, and which windows these are."""
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 8)
    sent = docs.select(text_or_empty().alias("text"), _key().alias("key")).mapInArrow(
        _send(parts, crowded, held), "part bigint, strings binary, least binary, most binary"
    )
    return sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(_judge, SHARED)


def without_repeats(docs: DataFrame, into: str, part: int = PART, held: int = HELD) -> DataFrame:
    """``docs`` with the struct ``into``: ``n_words, n_removed`` and the ``text`` of the words that stay."""
    small_batches(docs)
    spark = docs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    parts = max(SLOTS * least, -(-size // part))
    texts = docs.select(text_or_empty().alias("text"), F.hash(text_or_empty()).alias("key"))
    crowded = spark.sparkContext.broadcast(crowded_slots(texts, parts))
    with staged(shared_runs(docs, parts, crowded, held), "substring-shared") as shared:
        found = texts.mapInArrow(_occurrences(parts * SLOTS, crowded), "id bigint, text_key int").join(shared, "id")
        lists = found.groupBy("text_key").agg(F.collect_set(F.struct("id", "proof", "who", "bits")).alias("shared"))
        lists = written(lists, "substring-lists")
    key, list_ = free(docs, "text_key"), free(docs, "shared")
    lists = lists.select(F.col("text_key").alias(key), F.col("shared").alias(list_))
    met = docs.join(lists, F.hash(text_or_empty()) == F.col(key), "left")
    kept = _kept(parts * SLOTS, crowded)(text_or_empty(), _key(), F.col(list_))
    return met.select(*columns_of(docs), kept.alias(into))


def marked(docs: DataFrame) -> DataFrame:
    """Per document its words, how many are removed, and the digest of the rest."""
    kept = F.col("kept")
    return without_repeats(docs.select("doc_id", "text"), "kept").select(
        "doc_id",
        kept["n_words"].alias("n_words"),
        kept["n_removed"].alias("n_removed"),
        F.sha2(kept["text"].cast("binary"), 256).alias("kept_sha256"),
    )


def dedupe(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated words in ``text``, the others joined by a space; a null text stays null."""
    into = free(docs, "kept")
    text = F.when(F.col("text").isNotNull(), F.col(into)["text"]).alias("text")
    found = without_repeats(docs, into)
    return found.select(*(text if c == "text" else F.col(f"`{c}`") for c in docs.columns))
