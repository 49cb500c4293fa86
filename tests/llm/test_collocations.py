from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlake.llm import collocations
from gridlake.llm.superkmers import words_of
from tests.llm.conftest import sentence

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, words=4, top=2000):
    """``rows`` are ``lang, text``."""
    found, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, words + 1):
                found[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            inside = any(
                len(o) > len(p) and 100 * b >= 80 * a and any(o[i : i + len(p)] == p for i in range(len(o) - len(p) + 1))
                for o, b in candidates.items()
            )
            if not inside:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), " ".join(p), left, right))
        for rank, (score, a, _, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -score))
    return Counter(out)


def corpus():
    rng = random.Random(13)
    fixed = ["new york city", "in the end", "of the", "été à la mode", "Again And Again And Again", "x\x00y z\x85w"]
    rows = []
    for i in range(160):
        parts = [sentence(rng, rng.randint(0, 9), "abc") if rng.random() < 0.6 else rng.choice(fixed) for _ in range(8)]
        rows.append((("en", "de", None, "und")[i % 4], "".join(p + rng.choice([" ", "\t ", ". ", "\n", "!", "\r\n"]) for p in parts)))
    return [*rows, ("en", None), ("fr", ""), ("it", " .\n. "), ("es", "uno dos tres " * 200)]


@pytest.mark.parametrize(("least", "words", "top", "bits"), [(30, 4, 2000, 1 << 30), (3, 4, 25, 1 << 6), (2, 5, 2000, 1 << 8), (2, 2, 9, 1 << 30)])
def test_against_brute_force(spark, least, words, top, bits):
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = collocations.collocations(df, least=least, words=words, top=top, bits=bits)
    want = brute(rows, least, words, top)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 8


def test_cases(docs):
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    for least in (2, 30):
        got = Counter(tuple(r) for r in collocations.collocations(docs, least=least).collect())
        assert got == brute(rows, least)


def test_texts_are_read_in_blocks_at_the_ends_of_pieces(spark):
    rng = random.Random(3)
    rows = [("en", ". ".join(sentence(rng, 9, "ab") for _ in range(60_000))), ("en", "ab ba " * 200_000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = Counter(tuple(r) for r in collocations.collocations(df, least=400, words=3).collect())
    assert got == brute(rows, 400, 3) and len(got) > 20


def test_filter_holds_every_phrase(spark):
    rng = random.Random(1)
    rows = list({(rng.choice(["en", "dé"]), sentence(rng, 2)) for _ in range(5000)})
    df = spark.createDataFrame(rows, "lang string, phrase string")
    bits, sent = collocations.bloom(df)
    assert 16 * 5000 <= bits <= 32 * 5000
    for lang in ("en", "dé"):

        def member(found, seed=collocations._seed(lang)):
            words = words_of([p.encode() for p in found])
            return collocations.held(sent.value, bits, words.hashes(words.firsts[:-1], words.firsts[1:]) ^ seed)

        assert member([p for la, p in rows if la == lang]).all()
        assert member([sentence(rng, 3) for _ in range(2000)]).mean() < 0.01


def test_runs_are_cut_where_a_phrase_is_not_frequent():
    known = {b"a", b"b", b"c", b"a b", b"b c"}
    words = words_of(sorted(known))
    hashes = words.hashes(words.firsts[:-1], words.firsts[1:])
    cut = lambda text, k: collocations.frequent_runs(text, k, lambda h: np.isin(h, hashes))
    assert cut(b"a b x c a\n b\nc c", 1) == [b"a b", b"c a", b"c c"]
    assert cut(b"a b c\na b b c a b\n", 2) == [b"a b c"]
    assert cut(b"a\nb\n\nc", 1) == cut(b"", 1) == cut(b"x\ny", 1) == []
    assert cut(b"a b c", 2) == [b"a b c"] and cut(b"a b", 2) == []


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    words = spark.createDataFrame([("en", "a", big + 7), ("en", "b", big + 1)], "lang string, phrase string, n bigint")
    pairs = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, n bigint")
    got = collocations.scored([words, pairs]).first()
    assert got["score"] == 2_000_000 * big // (2 * big + 8)


def test_empty_table(empty):
    assert collocations.collocations(empty).count() == 0
