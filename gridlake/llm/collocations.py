"""Phrase collocations mined by relations of occurrences (SETM).

The relation of length k holds the occurrences of frequent phrases of k words, in the order of piece and position. Neighbours
in a piece lie side by side, so that it is kept as runs of words: a run of m words stands for the occurrences at its first
m - k + 1 positions, and an occurrence that no other one follows or precedes is left out, as it can't be extended.

1. The merge join of a relation with itself, by piece and adjacent position, reads each run's positions p and p + 1, which
   together are a phrase of k + 1 words.
2. These are counted, in tasks and then in one aggregate, and the frequent ones kept.
3. The semi-join with the frequent phrases cuts the runs anew: this is the relation of length k + 1, written and extended in
   its turn. It asks a Bloom filter of the frequent phrases, which never loses one. What it lets through by mistake is
   counted once more and dropped by its count, so that no result depends on the filter, of at most ``BITS`` bits.

A candidate is cut after each of its words, and scored by the cut with the lowest score; one that lies inside a longer
candidate found nearly as often is dropped.

Defined cases: a null text is empty, a null lang is ``und``; each row is a document, whatever its doc_id; a piece of fewer
words than a phrase has none; phrases of equal score and count are ordered by their bytes, equal cuts by the earlier; texts
of any length are read whole, a piece at a time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import A_TO_Z, LOWER, small_batches, staged, text_or_empty, written
from gridlake.llm.lines import PROBES, positions
from gridlake.llm.superkmers import words_of

LEAST = 30
WORDS = 4
TOP = 2000
# A longer phrase takes a shorter one's place when it has so many hundredths of its occurrences.
COVERED = 80
SCALE = 2_000_000
BITS = 1 << 30
BITS_PER_PHRASE = 16
# Bytes of text that are read at once, and phrases that a task counts before it sends them.
BLOCK = 1 << 20
HELD = 200_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_READ = bytes.maketrans(A_TO_Z.encode() + _ENDS + b"\t", LOWER.encode() + b"\n" * len(_ENDS) + b" ")

Run = list[bytes]


def runs_of(text: bytes) -> list[Run]:
    """The pieces of a text, as runs of words."""
    return [words for piece in text.translate(_READ).split(b"\n") if (words := piece.split())]


def phrases(run: Run, k: int) -> Iterator[bytes]:
    return iter(run) if k == 1 else map(b" ".join, zip(*(run[i:] for i in range(k)), strict=False))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Language and text, cut at the ends of pieces into blocks of about ``BLOCK`` bytes."""
    held: dict[str, list[bytes]] = defaultdict(list)
    size: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            text = (text.encode("utf-8", "replace") if isinstance(text, str) else text).translate(_READ)
            at = 0
            while at < len(text):
                end = text.find(b"\n", at + BLOCK)
                end = len(text) if end < 0 else end
                held[lang].append(text[at:end])
                size[lang] += end - at
                at = end + 1
                if size[lang] >= BLOCK:
                    yield lang, b"\n".join(held.pop(lang))
                    size[lang] = 0
    for lang, rest in held.items():
        yield lang, b"\n".join(rest)


def _count(k: int):
    """Phrases of ``k`` words with their number; the empty phrase counts all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                columns = [[lang] * len(found), list(found), list(found.values())]
                types = [pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "phrase", "n"]
                )

        for lang, text in _texts(batches):
            found = held[lang]
            for run in runs_of(text):
                if k == 1:
                    found[b""] += len(run)
                found.update(phrases(run, k))
            if sum(map(len, held.values())) >= HELD:
                yield from rows()
                held.clear()
        yield from rows()

    return count


def _cut(k: int, bits: int, sent: Broadcast):
    """The relation of length ``k``: runs of neighbouring phrases that the filter holds."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, text in _texts(batches):
            seed = _seed(lang)
            kept = frequent_runs(text, k, lambda hashes, seed=seed: held(sent.value, bits, hashes ^ seed))
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([b"\n".join(kept)], pa.binary())], ["lang", "runs"]
                )

    return cut


def frequent_runs(text: bytes, k: int, member: Callable[[np.ndarray], np.ndarray]) -> list[bytes]:
    """Stretches of the pieces of ``text`` with at least two neighbouring phrases of ``k`` words that are all members."""
    words = words_of(text.split(b"\n"))
    piece = np.repeat(np.arange(len(words.firsts) - 1), np.diff(words.firsts))
    n = len(piece)
    if n <= k:
        return []
    first = np.flatnonzero(piece[: n - k + 1] == piece[k - 1 :])
    # One place is left free between pieces, so that no run goes on from one into the next.
    marks = np.zeros(n + len(words.firsts) + 1, np.int8)
    chosen = first[member(words.hashes(first, first + k))]
    marks[chosen + piece[chosen]] = 1
    edges = np.flatnonzero(np.diff(marks, prepend=0))
    begin, end = edges[::2], edges[1::2]
    begin, size = begin[end - begin > 1], (end - begin)[end - begin > 1]
    # Where a place belongs: pieces begin at their first word plus their number.
    offset = np.searchsorted(words.firsts + np.arange(len(words.firsts)), begin, side="right") - 1
    return words.cut(begin - offset, begin - offset + size + k - 1)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "replace")))


def held(filter_: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter holds each hash; most are out at the first probe."""
    step, left = (hashes >> np.uint64(32)) | np.uint64(1), np.arange(len(hashes))
    for probe in range(PROBES):
        at = (hashes[left] + step[left] * np.uint64(probe)) & np.uint64(bits - 1)
        left = left[(filter_[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
    found = np.zeros(len(hashes), bool)
    found[left] = True
    return found


def _bits(bits: int):
    """The filter's words that phrases set bits of, with those bits."""

    def set_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = np.array([_seed(lang) for lang in batch.column(0).to_pylist()], np.uint64)
            words = words_of([phrase.as_py().encode("utf-8", "replace") for phrase in batch.column(1)])
            at = positions(words.hashes(words.firsts[:-1], words.firsts[1:]) ^ seeds, bits).ravel()
            order = np.argsort(at >> np.uint64(6), kind="stable")
            place, bit = (at >> np.uint64(6))[order], (np.uint64(1) << (at & np.uint64(63)))[order]
            begins = np.flatnonzero(np.concatenate([[True], np.diff(place) != 0]))
            columns = [pa.array(place[begins].astype(np.int64)), pa.array(np.bitwise_or.reduceat(bit, begins).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["place", "bits"])

    return set_


def bloom(frequent: DataFrame, most: int = BITS) -> tuple[int, Broadcast]:
    """Size and bits of a filter of ``lang, phrase``."""
    n = max(1, frequent.count())
    bits = int(min(most, max(1 << 13, 1 << math.ceil(math.log2(n * BITS_PER_PHRASE)))))
    found = frequent.mapInArrow(_bits(bits), "place bigint, bits bigint")
    found = found.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    filter_ = np.zeros(bits // 64, np.uint64)
    filter_[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits, frequent.sparkSession.sparkContext.broadcast(filter_)


def frequent_phrases(docs: DataFrame, least: int, words: int, bits: int, stack: ExitStack) -> list[DataFrame]:
    """``lang, phrase, n`` of the frequent phrases of 1, 2, ... words; with one word, also the empty phrase."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    relation = docs.select(lang, text_or_empty().alias("runs"))
    found = []
    for k in range(1, words + 1):
        # Tasks have added up what they could; a second aggregate before the exchange would find little to add.
        counts = relation.mapInArrow(_count(k), "lang string, phrase string, n bigint").repartition("lang", "phrase")
        counts = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        enough = counts.filter((F.col("n") >= least) | (F.col("phrase") == ""))
        found.append(stack.enter_context(staged(enough, f"collocation-counts{k}")))
        if k < words:
            size, sent = bloom(found[-1].filter("phrase <> ''").select("lang", "phrase"), bits)
            cut = relation.mapInArrow(_cut(k, size, sent), "lang string, runs binary")
            relation = stack.enter_context(staged(cut, f"collocation-runs{k}"))
    return found


def _part(begin: int | str, size: str) -> str:
    return f"concat_ws(' ', slice(words, {begin}, {size}))"


def scored(found: list[DataFrame]) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every candidate, at its lowest cut."""
    parts = reduce(DataFrame.unionByName, found).filter("phrase <> ''")
    candidates = reduce(DataFrame.unionByName, found[1:]).select("lang", "phrase", F.col("n").alias("a"))
    cuts = candidates.withColumn("words", F.split("phrase", " ")).selectExpr(
        "lang", "phrase", "a", "words", "explode(sequence(1, size(words) - 1)) as k"
    )
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", f"{_part(1, 'k')} as head", f"{_part('k + 1', 'size(words) - k')} as tail")
    left = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    score = F.call_function(
        "div", F.lit(SCALE).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)"), (F.col("l") + F.col("r")).cast("decimal(20,0)")
    )
    met = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"]).withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return met.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covers(found: list[DataFrame]) -> DataFrame:
    """``lang, phrase, cover``: of phrases inside longer candidates, the most occurrences of one of these."""
    longer = reduce(DataFrame.unionByName, found[2:]).withColumn("words", F.split("phrase", " "))
    sized = longer.selectExpr("lang", "n", "words", "explode(sequence(2, size(words) - 1)) as k")
    inside = sized.selectExpr("lang", "n", "words", "k", "explode(sequence(1, size(words) - k + 1)) as i")
    return inside.selectExpr("lang", "n", f"{_part('i', 'k')} as phrase").groupBy("lang", "phrase").agg(F.max("n").alias("cover"))


def collocations(docs: DataFrame, least: int = LEAST, words: int = WORDS, top: int = TOP, bits: int = BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``words`` words."""
    small_batches(docs)
    with ExitStack() as stack:
        found = frequent_phrases(docs, least, words, bits, stack)
        totals = found[0].filter("phrase = ''").select("lang", F.col("n"))
        kept = scored(found)
        if len(found) > 2:
            own = F.coalesce(100 * F.col("cover") < COVERED * F.col("a"), F.lit(True))
            kept = kept.join(covers(found), ["lang", "phrase"], "left").filter(own)
        best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        ranks = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        ranks = ranks.join(F.broadcast(totals), "lang").select(
            "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
        )
        return written(ranks, "collocations")
