from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridlake.llm import substrings, superkmers
from tests.llm.conftest import sentence

SPACE = str.maketrans("\t\n\x0b\x0c\r", "     ")
LAST = (1 << 63) - 1


def words(text):
    return [w for w in (text or "").translate(SPACE).split(" ") if w]


def brute(rows):
    first = {}
    for i, t in rows:
        w = words(t)
        key = LAST if i is None else i
        for at in range(len(w) - 12):
            window = tuple(w[at : at + 13])
            first[window] = min(key, first.get(window, key))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for at in range(len(w) - 12):
            if first[tuple(w[at : at + 13])] < (LAST if i is None else i):
                gone.update(range(at, at + 13))
        out.append((i, len(w), len(gone), " ".join(x for at, x in enumerate(w) if at not in gone)))
    return out


def hashed(found):
    return Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in found)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


def test_cases(docs, rows):
    want = brute([(i, t) for i, t, _ in rows])
    assert Counter(tuple(r) for r in substrings.marked(docs).collect()) == hashed(want)
    assert sum(n for _, _, n, _ in want) > 300
    kept = substrings.dedupe(docs)
    assert kept.columns == docs.columns
    null = {i for i, t, _ in rows if t is None}
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter((i, None if i in null else t) for i, _, _, t in want)


def passages(n=60):
    """Documents with passages of many, edges that are all different, repetition inside, copies, and ids that repeat."""
    rng = random.Random(11)
    shared = [sentence(rng, k) for k in (12, 13, 14, 40, 90)]
    rows = []
    for i in range(n):
        text = sentence(rng, 8) + "\n" + shared[i % 5] + " \t " + sentence(rng, 9) + "  " + shared[3]
        rows.append((i // 2 if i % 7 else None, text))
    rows += [(100 + i, shared[4]) for i in range(20)]
    rows += [(200, "again " * 300), (201, "again " * 200 + "end"), (202, "again " * 13), (203, "again " * 12)]
    rows += [(204, sentence(rng, 13, "é\U0001f600ñ\x00")), (LAST, shared[4]), (-5, shared[2] + " tail")]
    return rows


@pytest.mark.parametrize(("part", "held"), [(substrings.PART, substrings.HELD), (500, 7)])
def test_neither_parts_nor_flushes_change_results(spark, part, held):
    rows = passages()
    found = substrings.without_repeats(frame(spark, rows), "kept", part=part, held=held)
    assert Counter((r[0], *r[2]) for r in found.collect()) == Counter(brute(rows))


def test_crowded_slots_are_dealt_by_window(spark):
    rng = random.Random(5)
    edge = sentence(rng, 12)
    rows = [(i, sentence(rng, 12) + " " + edge + " " + sentence(rng, 12)) for i in range(300)]
    df = frame(spark, rows)
    texts = df.selectExpr("text", "doc_id as key")
    crowded = substrings.crowded_slots(texts, 16)
    assert 0 < len(crowded) <= 8
    words_ = superkmers.words_of([t.encode() for _, t in rows])
    alone = superkmers.runs_of(words_, 64, crowded)
    load = np.bincount((alone.key % np.uint64(16)).astype(int), alone.size, 16)
    whole = superkmers.runs_of(words_)
    before = np.bincount((whole.key % np.uint64(16)).astype(int), whole.size, 16)
    assert load.max() < before.max() and load.max() < 3 * load.mean()
    assert Counter(tuple(r) for r in substrings.marked(df).collect()) == hashed(brute(rows))


def test_words_and_runs():
    texts = [b"  a bb\tccc ", b"", b" \n", b"d", " ".join(map(str, range(40))).encode()]
    found = superkmers.words_of(texts)
    assert np.diff(found.firsts).tolist() == [3, 0, 0, 1, 40]
    assert found.cut(np.array([0, 3]), np.array([3, 4])) == [b"a bb ccc", b"d"]
    runs = superkmers.runs_of(found)
    assert runs.size.sum() == 28 and set(runs.text.tolist()) == {4}
    covered = [i for f, n in zip(runs.first.tolist(), runs.size.tolist(), strict=True) for i in range(f, f + n)]
    assert covered == list(range(4, 32))


def test_runs_end_after_the_longest():
    found = superkmers.words_of([b"again " * 300])
    assert superkmers.runs_of(found).size.tolist() == [64, 64, 64, 64, 32]


def test_equal_windows_share_their_key():
    rng = random.Random(3)
    inner = sentence(rng, 30)
    keys = []
    for _ in range(2):
        found = superkmers.words_of([(sentence(rng, 25) + " " + inner + " " + sentence(rng, 25)).encode()])
        runs = superkmers.runs_of(found)
        per_window = np.repeat(runs.key, runs.size)
        keys.append(per_window[25 : 25 + 18].tolist())
    assert keys[0] == keys[1]


def test_pieces_cover_every_window(monkeypatch):
    monkeypatch.setattr(superkmers, "BLOCK", 50)
    rng = random.Random(9)
    for text in (sentence(rng, 200), "x" * 400 + " " + sentence(rng, 40) + " " + "y" * 300, "z" * 500, ""):
        all_words = text.split()
        windows = set()
        for at, piece in superkmers.pieces(text.encode()):
            part = [w.decode() for w in piece.split()]
            assert part == all_words[at : at + len(part)]
            windows.update(range(at, at + len(part) - 12))
        assert windows == set(range(max(0, len(all_words) - 12)))


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(superkmers.Words, "hashes", lambda self, first, last: np.zeros(len(first), np.uint64))
    a, b = " ".join(map(str, range(14))).encode(), " ".join(map(str, range(1, 14))).encode()
    found = substrings.first_documents([a, b, b"p " * 12 + b"p"], np.array([1, 2, 3]), np.array([1, 2, 3]))
    assert [x.tolist() for x in found] == [[0, 1], [1, 1], [2, 1]]


def test_long_text(spark):
    rng = random.Random(1)
    long = sentence(rng, 400_000)
    tail = " ".join(long.split()[-5000:])
    rows = {r.doc_id: r for r in substrings.marked(frame(spark, [(2, long), (1, tail), (3, long[:-1])])).collect()}
    assert rows[1].n_removed == 0 and rows[2].n_removed == 5000 and 400_000 - rows[3].n_removed <= 1


def test_empty_table(empty):
    assert substrings.marked(empty).count() == 0
    assert substrings.dedupe(empty).count() == 0
