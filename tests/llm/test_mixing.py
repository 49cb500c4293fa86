from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlake.llm import mixing


def water(sizes: list[int], weights: list[int]) -> list[float]:
    """Targets by repeated resharing."""
    total, full = float(sum(sizes)), set()
    while True:
        free = [k for k in range(len(sizes)) if k not in full]
        rest = total - sum(3 * sizes[k] for k in full)
        share = {k: rest * weights[k] / sum(weights[j] for j in free) for k in free}
        over = {k for k in free if share[k] > 3 * sizes[k]}
        if not over:
            return [3.0 * sizes[k] if k in full else share[k] for k in range(len(sizes))]
        full |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 1000, 5], [7], [0, 0, 3], [1, 1, 1, 1, 1, 996], [4, 4, 4, 4]])
def test_targets(spark, sizes):
    rows = [(f"s{k:02d}", n, 1) for k, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, source_size bigint, n_rows bigint")
    got = [r.target for r in mixing.targets(df).orderBy("source").collect()]
    assert got == pytest.approx(water(sizes, [(5, 2, 1)[k % 3] for k in range(len(sizes))]))


def test_mix_of_documents(docs, rows):
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows)
    assert sum(r.taken for r in found) <= sum(r.size for r in found)
    for r in found:
        assert r.size == len(next((t or "").split() for i, t, _ in rows if i == r.doc_id)) or r.doc_id is None
        assert 0 <= r.taken <= 3 * r.size
    again = mixing.mixed(docs.repartition(3)).collect()
    assert Counter(found) == Counter(again)
    assert sorted({r.source_size for r in found}) == sorted({sum(len((t or "").split()) for _, t, s in rows if s == x) for x in "abcd"} | {sum(len((t or "").split()) for _, t, s in rows if s is None)})


def test_taken_is_near_target(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "repeat('w ', cast(1 + id % 37 as int)) as text",
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then 'few' else concat('s', id % 7) end as source",
    )
    found = mixing.mixed(docs).withColumn("source", F.lit(0)).groupBy("source_size", "target").agg(F.sum("taken").alias("t"))
    for r in found.collect():
        assert abs(r.t - r.target) <= 2 * 37 + 0.01 * r.target


@pytest.mark.parametrize("seed", range(10))
def test_repeated_rows_are_taken_one_by_one(spark, seed):
    """A source of 90 000 words, of which two thirds are one row without a doc_id."""
    docs = spark.range(9000).selectExpr(
        "case when id < 2000 then null else id end as doc_id",
        "repeat('w ', case when id < 2000 then 30 when id < 4000 then 15 else 12 end) as text",
        "case when id < 4000 then 'c' when id < 6000 then 'a' else 'b' end as source",
    )
    rows = mixing.schedule(docs, seed=seed)
    words = rows.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.count("*").alias("n"))
    found = words.collect()
    assert sorted(r.n for r in found) == [2000, 3000, 4000]
    for r in found:
        assert abs(r.t - r.target) <= 30
    if seed > 1:
        return
    mixed = mixing.mix(docs, seed=seed).groupBy("source", "doc_id").count()
    by_source = mixed.groupBy("source").agg(F.sum("count").alias("n")).collect()
    want = rows.groupBy(F.when(F.col("doc_id").isNull() | (F.col("doc_id") < 4000), "c").when(F.col("doc_id") < 6000, "a").otherwise("b").alias("source")).agg(F.sum("copies").alias("n"))
    assert sorted(map(tuple, by_source)) == sorted(map(tuple, want.collect()))


def test_one_repeated_row_alone(spark):
    docs = spark.range(5000).selectExpr("1L as doc_id", "'w w w' as text", "case when id < 4000 then 'a' else 'b' end as source")
    found = mixing.mixed(docs)
    assert found.count() == 5000
    for r in found.groupBy("source_size", "target").agg(F.sum("taken").alias("t"), F.max("taken").alias("m")).collect():
        assert abs(r.t - r.target) <= 3 and r.m <= 9
    assert mixing.mix(docs).count() == found.agg(F.sum("taken")).first()[0] // 3


def test_mix_repeats_rows(docs):
    copies = mixing.schedule(docs).groupBy("doc_id").agg(F.sum("copies").alias("n"))
    want = {r.doc_id: r.n for r in copies.collect() if r.n}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert dict(Counter(r.doc_id for r in out.collect())) == want


def test_order_of_merge_matches_plain_queueing(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 9 as int)) as text", "concat('s', id % 4) as source")
    plan = mixing.schedule(docs)
    rows = plan.collect()
    by_queue = defaultdict(list)
    for r in rows:
        by_queue[r.queue].append(r)
    events = []
    for queue in by_queue.values():
        # Any one order per source will do; ``sent`` must be its running sum.
        queue.sort(key=lambda r: r.sent)
        total = 0
        for r in queue:
            total += r.size
            assert r.sent == total
        events += [((r.sent + c * r.source_size) / r.target, r.size, r.doc_id) for r in queue for c in range(3)]
    events.sort()
    budget, taken = sum(q[0].target for q in by_queue.values()), Counter()
    for finish, size, doc in events:
        if size > budget + 1e-6:
            break
        budget -= size
        taken[doc] += 1
    assert {r.doc_id: r.copies for r in rows if r.copies} == dict(taken)


def test_empty_table(empty):
    assert mixing.mixed(empty).count() == 0
    assert mixing.mix(empty).count() == 0


def test_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "  ", None)], "doc_id bigint, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mixed(docs).collect()] == [(0, 0.0), (0, 0.0)]
    assert mixing.mix(docs).count() == 0
