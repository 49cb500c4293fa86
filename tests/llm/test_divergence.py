from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pytest

from gridlake.llm import divergence
from tests.llm.conftest import sentence

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=50):
    """``rows`` are ``lang, source, text``."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = [(la, s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(SMALL))) for la, s, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        docs = Counter(t for la, _, terms in found if la == lang for t in set(terms))
        kept = sorted(t for t, n in docs.items() if n >= least)
        counts = defaultdict(Counter)
        for la, s, terms in found:
            if la == lang:
                counts[s].update(t for t in terms if docs[t] >= least)
        total = sum(counts.values(), Counter())

        def share(group, kept=kept):
            n = sum(group.values())
            return {t: 1 + 10**9 * (group[t] + 5) // (n + 5 * len(kept)) for t in kept}

        shares, q = {s: share(c) for s, c in counts.items()}, share(total)
        for s, p in shares.items():
            parts = {
                "pair": [(-sum(abs(p[t] - o[t]) for t in kept), x) for x, o in shares.items() if x != s],
                "term": [(q[t] - p[t], t) for t in kept if counts[s][t] > 0 and p[t] > q[t]],
            }
            for part, values in parts.items():
                ranks = sorted(values, key=lambda x: (x[0], x[1].encode()))
                for rank, (value, item) in enumerate(ranks[: top if part == "term" else None], 1):
                    out.append((lang, s, part, item, -value, rank))
    return Counter(out)


def corpus():
    rng = random.Random(12)
    sources = ["big"] * 6 + ["a", "b", "é", None, "Z"]
    rows = []
    for i in range(150):
        lang = "en" if i % 3 else rng.choice(["fr", None, ""])
        rows.append((lang, rng.choice(sources), sentence(rng, rng.randint(0, 60), "abcÉé") + " The the\x00THE " * (i % 4)))
    return [*rows, ("xx", "only", "few words"), ("xx", "other", None), ("yy", "one", "word " * 90), ("yy", "one", "")]


@pytest.mark.parametrize(("least", "block", "top"), [(30, 4096, 50), (3, 7, 4), (1, 1, 50)])
def test_against_brute_force(spark, least, block, top):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    got = divergence.audit(df, least=least, block=block, top=top)
    want = brute(rows, least, top)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 50


def test_many_sources_meet_in_tiles(spark):
    rng = random.Random(2)
    rows = [("en", f"s{i % 140}", sentence(rng, 12, "ab")) for i in range(420)]
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    got = divergence.audit(df, least=5, block=16)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_cases(docs, rows):
    full = docs.select("lang", "source", "text").collect()
    for least in (1, 2, 100):
        got = Counter(tuple(r) for r in divergence.audit(docs, least=least).collect())
        assert got == brute([tuple(r) for r in full], least)


def test_distance_of_run_length_columns():
    rng = np.random.default_rng(4)
    for size in (1, 2, 50):
        dense = [np.repeat(rng.integers(0, 5, size), rng.integers(1, 4, size))[:size] for _ in range(2)]
        columns = []
        for x in dense:
            starts = np.flatnonzero(np.diff(x, prepend=-1))
            assert all(x[a] != x[b] for a, b in pairwise(starts))
            columns.append((starts, x[starts]))
        assert divergence.distance(*columns, size) == np.abs(dense[0] - dense[1]).sum()


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, terms = 7_000_000_000_000_003, 9_000_000_000_000_000_001, 1_234_567
    df = spark.createDataFrame([(n, total, terms)], "n bigint, total bigint, terms bigint")
    got = df.select(divergence.share(df["n"], df["total"].cast("decimal(20,0)"), df["terms"])).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_equal_counts_lie_together(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = [("en", "a", " ".join(words)), ("en", "b", " ".join(words[::3] * 2)), ("en", "c", " ".join(words[::7] * 5))]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    with divergence.ExitStack() as stack:
        counted = divergence.Counted(df, 1, stack)
        columns = divergence.run_length_columns(counted, 4096, stack).collect()
    assert sum(len(r["starts"]) for r in columns) <= 3 * 7 and {sum(r["size"] for r in columns)} == {900}


def test_empty_table(empty):
    assert divergence.audit(empty).count() == 0
