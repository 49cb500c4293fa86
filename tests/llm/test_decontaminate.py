from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from gridlake.llm import decontaminate
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for i, item in items:
        b = words(item)
        n = min(10, len(b))
        windows = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                hit |= set(range(k, k + n))
                if i is not None:
                    found.add(str(i))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def items(rows):
    base = rows[0][1].split()
    return [
        (1, " ".join(base[10:40])),
        (2, " ".join(base[100:])),
        (10, "one two, THREE"),
        (11, " ".join(rows[7][1].split()[5990:])),
        (12, None),
        (13, "..."),
        (None, " ".join(rows[3][1].split()[:12])),
        (14, " ".join(base[35:50]) + " nothing"),
        (14, " ".join(base[35:50]) + " nothing"),
        (15, "the " * 12),
        (16, "çödé \U0001f600 ünï çödé " + "\U0001f600 Ünï çödé " * 4),
    ]


def test_cases(spark, docs, rows):
    bench = spark.createDataFrame([(*x, "extra") for x in items(rows)], "item_id bigint, text string, match0 string")
    got = sorted((tuple(r) for r in decontaminate.judged(docs, bench).collect()), key=repr)
    assert got == sorted(((i, *brute(t, items(rows))) for i, t, _ in rows), key=repr)
    clean = decontaminate.keep_clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not r[-1] for r in got)


def test_blocks_of_a_large_benchmark_agree(spark, docs, rows):
    bench = spark.createDataFrame(items(rows), "item_id bigint, text string")
    columns = ["doc_id", "m.n_words", "m.n_hit", "m.items", "m.longest"]
    plain = docs.select("doc_id", "text")
    one = decontaminate.matches(plain, bench, "m").select(columns).collect()
    many = decontaminate.matches(plain, bench, "m", most=100).select(columns).collect()
    assert sorted(one, key=repr) == sorted(many, key=repr)


def test_longest_match_and_its_place():
    rng = random.Random(1)
    item = sentence(rng, 40).split()
    doc = sentence(rng, 30).split() + item[5:33] + ["x"] + item[:12]
    bench = decontaminate.Benchmark([("7", " ".join(item))])
    (found,) = decontaminate.match_shard([decontaminate.item_words(" ".join(doc))], bench)
    assert (found["longest"], found["longest_item"], found["longest_at"], found["longest_from"]) == (28, "7", 30, 5)
    assert found["n_hit"] == 28 + 12


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    words_ = np.append(rng.integers(1, 4, 400), 0).astype(np.int32)
    array = decontaminate.suffix_array(words_, np.arange(400), 10)
    rows = [words_[k : k + 10].tolist() for k in array]
    assert rows == sorted(rows)


def test_random_texts_with_few_words():
    rng = random.Random(8)
    items_ = [(k, sentence(rng, rng.choice([2, 9, 10, 11, 25]), "ab")) for k in range(12)]
    texts = [sentence(rng, rng.choice([0, 1, 5, 60, 400]), "ab") for _ in range(40)]
    bench = decontaminate.Benchmark([(i, t) for i, t in items_])
    found = decontaminate.match_shard([decontaminate.item_words(t) for t in texts], bench)
    for text, r in zip(texts, found, strict=True):
        n, hit, count, _, _ = brute(text, items_)
        assert (r["n_words"], r["n_hit"], len(r["items"])) == (n, hit, count)


def test_empty_tables(spark, docs, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.judged(docs, none).filter("contaminated").count() == 0
    assert decontaminate.keep_clean(docs, none).count() == docs.count()
    bench = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    assert decontaminate.judged(empty, bench).count() == 0
