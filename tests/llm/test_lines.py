from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlake.llm import lines

SPACE = " \t\n\x0b\x0c\r"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    key = lambda line: line.strip(SPACE).translate(SMALL)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add((i is None, i or 0))
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = []
        for line in all_lines:
            who = holders[key(line)]
            if len(key(line)) < 10 or len(who) < 2 or min(who) == (i is None, i or 0):
                kept.append(line)
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return out


def hashed(found):
    return Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in found)


def test_cases(docs, rows):
    want = brute([(i, t) for i, t, _ in rows])
    assert Counter(tuple(r) for r in lines.marked(docs).collect()) == hashed(want)
    assert sum(d for _, _, d, _ in want) > 4
    kept = lines.dedupe(docs)
    assert kept.columns == docs.columns
    null = {i for i, t, _ in rows if t is None}
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter((i, None if i in null else t) for i, _, _, t in want)


@pytest.mark.parametrize(("most", "broadcast"), [(1 << 17, 0), (1 << 17, 10**6), (1 << 10, 0)])
def test_neither_filter_size_nor_join_changes_results(docs, rows, most, broadcast, monkeypatch):
    monkeypatch.setattr(lines, "SEGMENT", 1 << 10)
    found = lines.without_repeats(docs.select("doc_id", "text"), "kept", most=most, broadcast=broadcast)
    got = Counter((r[0], *r[1]) for r in found.select("doc_id", "kept").collect())
    assert got == Counter(brute([(i, t) for i, t, _ in rows]))


def test_filters_never_lose_a_repeat():
    rng = np.random.default_rng(1)
    one, two = (rng.integers(0, 1 << 63, 4000, np.uint64) for _ in range(2))
    filters = lines.Filters(1 << 12)
    filters.add(np.concatenate([one, two[:5]]))
    filters.add(np.concatenate([two, one[:50]]))
    assert lines.get(filters.twice, lines.positions(np.concatenate([one[:50], two[:5]]), 1 << 12)).all()
    wide = lines.Filters(1 << 20)
    wide.add(one)
    wide.add(two)
    assert not wide.twice.any()


def test_key():
    assert lines.key_of(b" \tAbcdefghiJ\r") == b"abcdefghij"
    assert lines.key_of("ééééééééé".encode()) is None and lines.key_of("éééééééééé".encode())


def test_empty_table(empty):
    assert lines.marked(empty).count() == 0
    assert lines.dedupe(empty).count() == 0
