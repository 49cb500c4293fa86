from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest

from gridlake.llm import urls

CASES = [
    ("https://a.example.net/en/1?x#y", "a.example.net", "/en/1", "example.net/en/"),
    ("http://Example.NET/de", "example.net", "/de", "net/"),
    ("http://net/", "net", "/", "net/"),
    ("http://net", "net", "", None),
    ("http://subnet/", "subnet", "/", None),
    ("x://example.com/de/1", "example.com", "/de/1", "example.com/de/"),
    ("http://badexample.com/de/1", "badexample.com", "/de/1", None),
    ("http://a.org/fr/?q=://b", "a.org", "/fr/", "org/fr/"),
    ("http://a.org/FR/", "a.org", "/FR/", None),
    ("no scheme", "", "", None),
    ("http://?q", "", "", None),
    ("", "", "", None),
    (None, "", "", None),
]


def test_host_path_and_rules(spark):
    pages = spark.createDataFrame([(k, c[0], "h") for k, c in enumerate(CASES)], "page_id bigint, url string, host2 string")
    got = {r.page_id: (r.host, r.path, r.rule, r.ruling) for r in urls.ruled(pages).collect()}
    action = {text: a for a, text in urls.RULES}
    assert got == {k: (h, p, r, action.get(r)) for k, (_, h, p, r) in enumerate(CASES)}


def plain_model(texts, order):
    counts = defaultdict(Counter)
    for text in texts:
        signs = [0] * order + text + [0]
        for i in range(order, len(signs)):
            for k in range(order + 1):
                counts[tuple(signs[i - k : i])][signs[i]] += 1

    def chance(context, sign):
        below = chance(context[1:], sign) if context else 1 / urls.SIGNS
        seen = counts[context]
        if not seen:
            return below
        return (seen[sign] + len(seen) * below) / (sum(seen.values()) + len(seen))

    return chance


@pytest.mark.parametrize("order", [0, 1, 2])
def test_model_matches_plain_counts(spark, order):
    good, bad = [[1, 2, 3, 1, 2], [1, 2], [4]], [[3, 3, 3, 1], [2, 1]]
    text = lambda t: "".join(chr(96 + c) for c in t)
    rows = [(True, text(t)) for t in good] + [(False, text(t)) for t in bad]
    df = spark.createDataFrame(rows, "accepted boolean, t string")
    model = urls.train(df.select("accepted", urls.grams(df["t"], order).alias("grams")), order)
    got = {r.gram: r.ratio for r in model.collect()}
    a, r = plain_model(good, order), plain_model(bad, order)
    assert len(got) == urls.SIGNS ** (order + 1)
    for gram, ratio in got.items():
        signs = [(gram // urls.SIGNS**k) % urls.SIGNS for k in range(order, -1, -1)]
        context, sign = tuple(signs[:-1]), signs[-1]
        assert ratio == pytest.approx(math.log(a(context, sign) / r(context, sign)), abs=1e-9)


def test_verdicts(spark):
    rows = [(k, f"http://good{k}.example.net/en/{k}") for k in range(40)]
    rows += [(100 + k, f"http://spam-spam{k}.example.net/de/{k}") for k in range(40)]
    rows += [(500, "http://goodx.other/en/1"), (501, "http://spam-spamx.other/de/2"), (502, None), (502, None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, rule string, grams int")
    got = [(r.page_id, r.verdict) for r in urls.judged(pages, order=2).collect()]
    found = dict(got)
    assert len(got) == len(rows) and found[500] == "allow" and found[501] == "block"
    assert all(found[k] == "allow" and found[100 + k] == "block" for k in range(40))
    assert sum(k == 502 for k, _ in got) == 2


def test_the_whole_url_is_judged(spark):
    # Half of the trained URLs differ in the path alone, so that the threshold lies between the words.
    rows = [(k, f"http://a{k}.example.net/en/{k}" + "?topic=garden#topic" * (k % 2)) for k in range(80)]
    rows += [(100 + k, f"http://a{k}.example.net/de/{k}" + "?casino-win#casino" * (k % 2)) for k in range(80)]
    rows += [
        (500, "http://a.example.info/?topic=garden"),
        (501, "http://a.example.info/?casino-win"),
        (502, "http://a.example.info/#topic"),
        (503, "http://a.example.info/#casino"),
        (504, "?topic=garden"),
        (505, "?casino-win"),
        (506, "//a.example.info/?topic=garden"),
        (507, "//a.example.info/?casino-win"),
        (508, "a.example.info/?topic=garden&to=http://a.example.info"),
        (509, "a.example.info/?casino-win&to=http://a.example.info"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    found = {r.page_id: r.verdict for r in urls.judged(pages, order=2).collect()}
    assert [found[k] for k in range(500, 510)] == ["allow", "block"] * 5


def test_only_the_scheme_is_left_out(spark):
    cases = {
        "http://A.b/c?d#e": "A.b/c?d#e",
        "//host/x": "//host/x",
        "a.b/c?to=http://d": "a.b/c?to=http://d",
        "http://a/?to=http://d": "a/?to=http://d",
        None: "",
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = {r.url: r.text for r in df.select("url", urls.signs_of(df["url"]).alias("text")).collect()}
    assert got == cases


def test_one_class_only_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.com/")], "page_id bigint, url string")
    found = {r.page_id: r.verdict for r in urls.judged(pages, order=1).collect()}
    assert found[1] == "block" and found[2] in ("allow", "block")
    assert urls.judged(pages.limit(0), order=1).count() == 0


def test_no_python_runs(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id bigint, url string")
    plan = urls.judged(pages.repartition(2), order=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
