from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlake.llm import jaccard
from gridlake.llm.components import components


def shingle_set(text):
    words = (text or "").encode().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """``(doc_id, class, links)`` of each row, by comparing all that share a shingle."""
    sets = [shingle_set(t) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent, links = list(range(len(rows))), Counter()

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j > k).items():
            if 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[k] += 1
                links[j] += 1
                parent[find(j)] = find(k)
    members = defaultdict(list)
    for k in range(len(rows)):
        members[find(k)].append(k)
    first = {c: min((rows[k][0] is None, rows[k][0] or 0) for k in m) for c, m in members.items()}
    name = lambda k: None if first[find(k)][0] else first[find(k)][1]
    return Counter((rows[k][0], name(k), links[k]) for k in range(len(rows)))


def test_cases(docs, rows):
    got = Counter(tuple(r) for r in jaccard.classes(docs).collect())
    assert got == brute([(i, t) for i, t, _ in rows])


@pytest.mark.parametrize("broadcast_rows", [jaccard.BROADCAST_ROWS, 0])
def test_a_repeated_row_brings_its_text_once(spark, monkeypatch, broadcast_rows):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(7, text)] * 50 + [(None, text + " more")] * 50 + [(9, text + " again")]
    counts, blocked = [], jaccard.in_blocks

    def in_blocks(found, blocks):
        if "text" in found.columns:
            counts.append((found.count(), found.select("node").distinct().count()))
        return blocked(found, blocks)

    monkeypatch.setattr(jaccard, "in_blocks", in_blocks)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", broadcast_rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = Counter(tuple(r) for r in jaccard.classes(docs).collect())
    assert counts == [(3, 3)] and got == brute(rows)


def test_keep_one(docs, rows):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({c for _, c, _ in brute([(i, t) for i, t, _ in rows])})


@pytest.fixture(scope="module")
def crowd():
    """A large group of near copies at mixed distances, small groups, and single texts."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    rows, base = [], [word() for _ in range(150)]
    for k in range(160):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(150)] = word()
        rows.append((k, " ".join(copy)))
    for k in range(60):
        text = [word() for _ in range(rng.choice([3, 5, 7, 40, 300]))]
        rows.append((1000 + 2 * k, " ".join(text)))
        if len(text) > 30:
            text[rng.randrange(len(text))] = word()
        rows.append((1001 + 2 * k, " ".join(text)))
    return rows


def test_crowd_in_one_block(spark, crowd):
    docs = spark.createDataFrame(crowd, "doc_id bigint, text string").repartition(6)
    assert Counter(tuple(r) for r in jaccard.classes(docs).collect()) == brute(crowd)


def test_crowd_in_many_blocks(spark, crowd, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr("gridlake.llm.common.BROADCAST_ROWS", 0)
    docs = spark.createDataFrame(crowd, "doc_id bigint, text string").repartition(6)
    assert Counter(tuple(r) for r in jaccard.classes(docs).collect()) == brute(crowd)


def test_shared_sizes():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 200, n).astype(np.uint64)) for n in (1, 5, 150, 90, 90)]
    got = jaccard.shared(sets)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            assert got[a, b] == len(np.intersect1d(x, y))


def test_shingles_match_plain_ones():
    texts = ["a b c d e f", "", " \n", "a  b\tc d e", "one", "x y", "a b c d e f"]
    hashes, starts, words = jaccard.shingles([t.encode() for t in texts])
    assert words.tolist() == [len(t.split()) for t in texts]
    own = [set(hashes[starts[k] : starts[k + 1]].tolist()) for k in range(len(texts))]
    assert [len(s) for s in own] == [len(shingle_set(t)) for t in texts]
    assert own[0] == own[6] and len(own[0] & own[3]) == 1 and not own[4] & own[5]


def test_posterior_keeps_what_is_likely():
    assert all(jaccard.NEEDED[n] <= 0.8 * n for n in range(1, jaccard.HASHES + 1))
    assert jaccard.NEEDED[jaccard.HASHES] > 0.4 * jaccard.HASHES
    # A uniform prior: all matches or none, closed forms.
    assert jaccard.needed(8, 0.8, 1 - 0.8**9 - 1e-12) == 8 and jaccard.needed(8, 0.8, 0.9 * 0.2**9) == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 21), (21, 20), (30, 30), *((k, k + 1) for k in range(100, 160))]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 20: 20, 21: 20} | {k: 100 for k in range(100, 161)}
    assert got == want


def test_empty_table(empty):
    assert jaccard.classes(empty).count() == 0
    assert jaccard.keep_one(empty).count() == 0
