from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import language
from gridlake.llm.common import table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def model():
    counts = []
    for lang, text in (("aa", "abba baab abab"), ("bb", "cddc dccd cdcd"), ("ru", "жжзз ззжж")):
        words = language.Words([text])
        counts += [(lang, int(b), 1) for b in words.buckets]
        counts += [(lang, language.BUCKETS + int(s), 1) for s in words.scripts]
    return language.Model(counts)


def brute_viterbi(scores, penalty):
    best = max(
        itertools.product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda p: sum(scores[k, s] for k, s in enumerate(p)) - penalty * sum(a != b for a, b in itertools.pairwise(p)),
    )
    return list(best)


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(0)
    counts = np.array([5, 0, 1, 6, 2])
    scores = rng.normal(size=(14, 3)).astype(np.float32) * 2
    first = np.cumsum(counts) - counts
    got = language.viterbi(scores, first, counts, 1.5)
    for f, n in zip(first, counts, strict=True):
        if n:
            assert got[f : f + n].tolist() == brute_viterbi(scores[f : f + n], 1.5)


def test_spans_scripts_and_undefined(model):
    texts = ["abba abab baab abba baab, cddc dccd cdcd dccd cddc", "", "12 ..", "жзж abba", "ABAB"]
    found = language.label_texts(texts, model)
    assert [s["lang"] for s in found[0]["spans"]] == ["aa", "bb"]
    assert found[0]["spans"][0]["start"] == 0 and found[0]["spans"][1]["end"] == len(texts[0])
    assert [f["lang"] for f in found[1:3]] == ["und", "und"] and found[1]["score"] == 0
    assert [s["lang"] for s in found[3]["spans"]] == ["ru", "aa"]
    assert found[4]["lang"] == "aa" and found[4]["score"] == 1
    assert language.label_texts(["abc"], language.Model([]))[0]["lang"] == "und"


def test_held_out_accuracy(spark):
    docs = table(spark, SMALL, "documents")
    found = language.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 20
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_and_ids_are_no_inputs(spark):
    docs = table(spark, SMALL, "documents")
    model = language.train(docs.filter(~language.held_out()))
    lie = docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 1).withColumn("source", F.lit("s"))
    one, two = (d.select("text", language.identify(d, model).alias("f")).collect() for d in (docs, lie))
    assert sorted(map(repr, one)) == sorted(map(repr, two))


def test_cases(docs, rows):
    found = language.predicted(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out is not None and r.lang_pred in ("en", "und")
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {5, 6, 7}


def test_long_text_is_one_slice(model):
    rng = random.Random(2)
    text = " ".join(rng.choice(["abba", "baab"]) for _ in range(300_000))
    (found,) = language.label_texts([text], model)
    assert found["spans"] == [{"lang": "aa", "start": 0, "end": len(text)}]


def test_empty_table(empty):
    assert language.predicted(empty).count() == 0
