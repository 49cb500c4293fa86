"""Language of documents and of their spans: script ranges, per-word scores, Viterbi with a switching penalty.

The model counts character trigrams of every training document by language, hashed to ``BUCKETS`` (words and their edges
are in them: a boundary is a character). What reaches the driver is one number per language and used bucket, and the
letters of each script per language.

A word is a run of letters. Its score in a language is the sum of its trigrams' log probabilities. A language is a
candidate for a word only if at least ``SCRIPT_SHARE`` of its training letters are in the word's script; if none is, all
are. Viterbi finds the labelling of a document's words with the largest sum of scores less ``SWITCH`` per change of
language. The prediction is the language with most labelled letters, its score their share.

Defined cases: a null text, one without a letter, or an empty model give ``und``, score 0 and no spans; ties go to the
language first in order; repeated rows are judged alike; null labels are not learned from; an empty table gives no rows.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import small_batches, text_or_empty

BUCKETS = 1 << 16
SWITCH = 12.0
SMOOTHING = 0.05
SCRIPT_SHARE = 0.01
SLICE_CHARS = 1 << 20

# First and last code point of a script's main blocks. Fixed values.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)),
}
N_SCRIPTS = len(SCRIPTS) + 1


@lru_cache(maxsize=1)
def characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the lower-case letter (0 for no letter), and the script (0 for another)."""
    lower = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            small = c.lower()
            lower[i] = ord(small) if len(small) == 1 else i
    script = np.zeros(0x110000, np.uint8)
    for n, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            script[first : last + 1] = n
    return lower, script


class Words:
    """The words of some texts: trigram buckets of all letters, where words begin, their texts and places."""

    def __init__(self, texts: list[str]):
        lower, script = characters()
        code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "replace"), np.uint32)
        letter = lower[code].astype(np.uint64)
        padded = np.concatenate([[0], letter, [0]]).astype(np.uint64)
        at = np.flatnonzero(letter)
        mixed = (padded[at] * np.uint64(0x9E3779B1) + padded[at + 1]) * np.uint64(0x85EBCA77C2B2AE63) + padded[at + 2]
        mixed *= np.uint64(0x27D4EB2F165667C5)
        self.buckets = (mixed >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
        self.starts = np.flatnonzero(padded[at] == 0)
        self.letters = np.diff(np.append(self.starts, len(at)))
        self.scripts = script[code[at]]
        begin = at[self.starts]
        text_start = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text = np.searchsorted(text_start, begin, side="right") - 1
        self.begin = begin - text_start[self.text]


class Model:
    """Log probabilities by bucket and language, and which languages are candidates for a script."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.languages = sorted({lang for lang, _, _ in counts})
        place = {lang: k for k, lang in enumerate(self.languages)}
        n = np.zeros((BUCKETS + N_SCRIPTS, len(self.languages)))
        for lang, bucket, times in counts:
            n[bucket, place[lang]] += times
        seen = n[:BUCKETS] + SMOOTHING
        self.score = np.log(seen / seen.sum(0, keepdims=True)).astype(np.float32)
        scripts = n[BUCKETS:]
        self.candidate = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
        self.candidate[~self.candidate.any(1)] = True

    def word_scores(self, words: Words) -> np.ndarray:
        if not len(words.starts):
            return np.zeros((0, len(self.languages)), np.float32)
        scores = np.add.reduceat(self.score[words.buckets], words.starts, axis=0)
        barred = ~self.candidate[words.scripts[words.starts]]
        scores[barred] = -1e6
        return scores


def viterbi(scores: np.ndarray, first: np.ndarray, count: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Label of every word. Texts own ``count`` rows of ``scores`` from ``first`` on; all advance word by word together."""
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    label = np.zeros(len(scores), np.int16)
    if not len(scores):
        return label
    back = np.zeros(scores.shape, np.int16)
    n = int((count > 0).sum())
    value = scores[first[:n]].astype(np.float64)
    own = np.arange(scores.shape[1], dtype=np.int16)
    steps = int(count[0])
    live = np.searchsorted(-count, -np.arange(1, steps + 1), side="right")
    for t in range(1, steps):
        n = live[t]
        now = value[:n]
        best = now.argmax(1)
        changed = now[np.arange(n), best][:, None] - penalty
        back[first[:n] + t] = np.where(now >= changed, own, best[:, None])
        value[:n] = np.maximum(now, changed) + scores[first[:n] + t]
    state = value.argmax(1) if len(value) else np.zeros(0, np.int64)
    for t in range(steps - 1, -1, -1):
        n = live[t]
        rows = first[:n] + t
        label[rows] = state[:n]
        if t:
            state[:n] = back[rows, state[:n]]
    return label


def label_texts(texts: list[str], model: Model) -> list[dict]:
    """Per text: prediction, score, and spans as ``(language, first and last code point)``."""
    none = {"lang": "und", "score": 0.0, "spans": []}
    words = Words(texts)
    if not model.languages or not len(words.starts):
        return [none] * len(texts)
    first = np.searchsorted(words.text, np.arange(len(texts)))
    count = np.searchsorted(words.text, np.arange(len(texts)), side="right") - first
    label = viterbi(model.word_scores(words), first, count)
    letters = np.zeros((len(texts), len(model.languages)))
    np.add.at(letters, (words.text, label), words.letters)
    best = letters.argmax(1)
    share = letters[np.arange(len(texts)), best] / np.maximum(letters.sum(1), 1)
    new = np.concatenate([[True], (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(new)) - 1
    out = [
        {"lang": model.languages[b], "score": s, "spans": []} if c else none
        for b, s, c in zip(best.tolist(), share.tolist(), count.tolist(), strict=True)
    ]
    end = words.begin + words.letters
    for text, name, begin, stop in zip(
        words.text[at].tolist(), label[at].tolist(), words.begin[at].tolist(), end[last].tolist(), strict=True
    ):
        out[text]["spans"].append({"lang": model.languages[name], "start": begin, "end": stop})
    return out


def slices(texts: Iterator[str]) -> Iterator[list[str]]:
    """Texts in runs of about ``SLICE_CHARS``; a longer text is one by itself."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = (c.to_pylist() for c in batch.columns)
        for lang in sorted(set(langs)):
            total = totals.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
            for part in slices(t for t, own in zip(texts, langs, strict=True) if own == lang):
                words = Words(part)
                total[:BUCKETS] += np.bincount(words.buckets, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(words.scripts, minlength=N_SCRIPTS)
    for lang, total in totals.items():
        used = np.flatnonzero(total)
        columns = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])


def train(docs: DataFrame) -> Model:
    """A model of all ``text`` with a label ``lang``."""
    small_batches(docs)
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    counts = rows.mapInArrow(_count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n"))
    return Model([tuple(r) for r in counts.collect()])


RESULT = "lang string, score double, spans array<struct<lang string, start bigint, end bigint>>"
_SPAN = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))])


def identify(docs: DataFrame, model: Model) -> Column:
    """The struct ``lang, score, spans`` for the column ``text``."""
    return _identifier(docs.sparkSession.sparkContext.broadcast(model))(text_or_empty())


def _identifier(sent: Broadcast):
    def labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [row for part in slices(v.as_py() for v in batch) for row in label_texts(part, sent.value)]
            yield pa.array(rows, _RESULT)

    return F.arrow_udf(labels, RESULT)


def held_out() -> Column:
    """Documents that are never learned from: a fourth by the checksum of the id, and those without one."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(F.pmod(checksum, F.lit(4)) == 2, F.lit(True))


def predicted(docs: DataFrame) -> DataFrame:
    """Per document its predicted language, by a model of the documents that are not held out."""
    model = train(docs.filter(~held_out()))
    found = docs.select("doc_id", held_out().alias("held_out"), identify(docs, model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
