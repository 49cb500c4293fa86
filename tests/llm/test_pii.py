from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from gridlake.llm import pii

BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(d):
    return sum(int(c) if k % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def noisy(rng):
    parts = [
        "a@b.c", "x.y+z@mail.example.com", "@", "a@b", "%d@e.f", "..", "1.2.3.4", "256.1.1.1", "0001.2.3.255.9", ".", " ",
        "4111 1111 1111 1111", "4111-1111-1111-1112", "4539578763621486", "+1 (017) 555-7713", "+", "+1", "++49 30 1234567",
        "-", "\n", "é", "\U0001f600", "\x01", "\x02", "12", "999", "x", "call ", "+1234567890123456", "a.b", "@c.d", "(", ")",
    ]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))


def test_base_matches_plain_search(spark):
    rng = random.Random(3)
    texts = [noisy(rng) for _ in range(1500)] + ["", "7" * 5000, "a" * 5000 + "@", "1." * 3000, "+" + "1 " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    for r in pii.counted(docs).collect():
        want = base(texts[r.doc_id])
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest(), texts[r.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, *_ in want) for x, _ in BASE)
        assert r.spans == told or r.spans.startswith((told, "iban", "ssn"))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", "iban:7:34"),
        ("GB82WEST12345698765432.", "iban:0:22"),
        ("DE88 3704 0044 0532 0130 00", ""),
        ("my SSN: 123-45-6789", "ssn:8:19"),
        ("part no 123-45-6789", ""),
        ("ssn" + "x" * 60 + " 123-45-6789", ""),
        (None, ""),
    ],
)
def test_added_kinds(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.counted(docs).first().spans == want


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([(1, "call +1 234 567 89"), (2, "see +1 234 567 89")], "doc_id bigint, text string")
    scores = [r[0] for r in pii.found(docs).orderBy("doc_id").selectExpr("pii.phone[0].score").collect()]
    assert scores[0] > scores[1] == pii.PRIOR["phone"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("IBAN BE68 5390 0754 7034 BIC GKCCBEBB", "5:24"),
        ("BE68 5390 0754 7034.", "0:19"),
        ("ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", "0:29"),
        ("AT61 1904 3002 3457 3201 BIC X", "0:24"),
        ("BE68 5390 0754 7034 BE68 5390 0754 7034 BE68 5390 0754 7034 1", "0:19 20:39 40:59"),
        ("NO93 8601 1117 947 TEL 12", "0:18"),
        ("GB82WEST12345698765432 BIC", "0:22"),
        ("BE68539007547034 BIC", "0:16"),
        ("BE68 539007547034 BIC", "0:17"),
        ("MT84 MALT 0110 0001 2345 MTLC AST0 01S AND", "0:38"),
        ("REF AB12 0001 BE68 5390 0754 7034 BIC", "14:33"),
        ("BE12 3456 7890 BE68 5390 0754 7034", "15:34"),
        ("BE67 5390 0754 7034 BIC GKCCBEBB", ""),
        ("\U0001f600 DE89370400440532013000 é BE68 5390 0754 7034 TO é", "2:24 27:46"),
        ("AB12" * 3000, ""),
        (" ".join(["BE68 5390 0754 7034"] * 200), " ".join(f"{20 * k}:{20 * k + 19}" for k in range(200))),
    ],
)
def test_ibans_of_any_length_before_other_words(spark, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = [f"{s.start}:{s.end}" for s in pii.found(docs).first().pii.iban]
    assert " ".join(found) == want


def test_iban_of_a_country_without_a_length(spark):
    def made(country, rest):
        digits = "".join(str(int(c, 36)) for c in f"{rest}{country}00")
        return f"{country}{98 - int(digits) % 97:02d}{rest}"

    code = made("ZZ", "123456789012")
    text = " ".join(code[k : k + 4] for k in range(0, 16, 4))
    docs = spark.createDataFrame([(1, f"IBAN {text} BIC ABCDZZ2X")], "doc_id bigint, text string")
    assert [(s.start, s.end) for s in pii.found(docs).first().pii.iban] == [(5, 24)]


SSN = "123-45-6789"


@pytest.mark.parametrize(
    ("text", "n"),
    [
        (f"SSNs: {SSN}, {SSN}, {SSN}", 3),
        (f"SSNs: {', '.join([SSN] * 30)}", 30),
        (f"{', '.join([SSN] * 30)} (SSN)", 30),
        (f"ssn\n- {SSN}\n- {SSN}\n", 2),
        (f"{SSN} (SSN)", 1),
        (f"SSN 111-11-1111 and also {SSN}", 2),
        (f"{SSN} or part no {SSN}", 0),
        (f"ssn {'x' * 60} {SSN}, {SSN}", 0),
        (f"{SSN}, {SSN} {'x' * 60} ssn", 0),
        (f"SSN {SSN}, {SSN}{' ' * 41}{SSN}", 2),
        (f"\U0001f600SSN {'é' * 36} {SSN}", 0),
        (f"\U0001f600SSN {'é' * 35} {SSN}", 1),
        (f"{SSN} {'é' * 36}SSN", 1),
        (f"{SSN} {'é' * 37}SSN", 0),
        ("123-45-6780" * 2 + " ssn", 2),
    ],
)
def test_context_reaches_past_other_matches(spark, text, n):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    want = [f"ssn:{m.start()}:{m.end()}" for m in re.finditer("[0-9]{3}-[0-9]{2}-[0-9]{4}", text)][:n]
    assert pii.counted(docs).first().spans == ",".join(want)
    assert pii.redact(docs).first().text == re.sub("[0-9]{3}-[0-9]{2}-[0-9]{4}", "<ssn>", text, count=n) if n else text


def test_context_after_and_in_lists_raises_every_score(spark):
    docs = spark.createDataFrame([(1, "1.2.3.4, 4.3.2.1 are the hosts"), (2, "1.2.3.4, 4.3.2.1")], "doc_id bigint, text string")
    scores = [list(r[0]) for r in pii.found(docs).orderBy("doc_id").selectExpr("pii.ip.score").collect()]
    assert scores == [[pytest.approx(0.9)] * 2, [pii.PRIOR["ip"]] * 2]


def test_redact(spark, docs):
    text = "write a@b.co or +1 234 567 89 from 1.2.3.4, é end"
    own = spark.createDataFrame([(1, text), (2, None), (3, "none")], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in pii.redact(own).collect()}
    assert got == {1: "write <email> or <phone> from <ip>, é end", 2: None, 3: "none"}
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).count() == docs.count()


def test_cases(docs, rows, empty):
    found = pii.counted(docs).collect()
    assert len(found) == len(rows) and all(r.spans == "" for r in found)
    assert pii.counted(empty).count() == 0


def test_no_python_runs(docs):
    plan = pii.counted(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "of",
    [
        lambda n: ", ".join(f"a{i}@b{i}.com" for i in range(n)),
        lambda n: "\n".join(f"+49 30 {1000000 + i}" for i in range(n)),
        lambda n: "; ".join(["DE89 3704 0044 0532 0130 00"] * n),
    ],
)
def test_long_texts_take_time_in_proportion(spark, of):
    took = []
    for n in (50, 5_000, 40_000):
        docs = spark.createDataFrame([(1, of(n))], "doc_id bigint, text string")
        begun = time.monotonic()
        assert len(pii.counted(docs).first().spans.split(",")) == n
        took.append(time.monotonic() - begun)
    assert took[2] < 12 * took[1]


def test_redact_puts_long_texts_together(spark):
    text = ("é" * 5000 + " a@b.com " + "x" * 9000 + "\U0001f600 c@d.org") * 3
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.redact(docs).first().text == re.sub(r"[ac]@[bd]\.[a-z]{3}", "<email>", text)


def test_taken_names_are_refused(spark):
    docs = spark.createDataFrame([(1, "x", 2)], "doc_id bigint, text string, PII int")
    with pytest.raises(ValueError, match="pii"):
        pii.found(docs)
