from __future__ import annotations

from collections import Counter

from gridlake.llm import quality

SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words = "".join("\0" if c in SPACE else c for c in text).split("\0")
    words = [w for w in words if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {p for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


def test_measures_and_verdicts(docs, rows):
    got = sorted((r for r in quality.judged(docs).collect()), key=repr)
    assert len(got) == len(rows)
    want = Counter((i, *brute(t)) for i, t, _ in rows)
    assert Counter(tuple(r[:6]) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    assert {1, 2, 3, 4, 8, 11, 12} <= kept and not kept & {5, 6, 7, 9, 14, 15, 17}


def test_keep_good_leaves_columns(docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality.judged(docs).filter("kept").count()


def test_ablation_counts_by_bits(docs):
    ledger = quality.ledger(docs.select("doc_id", "text"))
    bits = [r[0] for r in ledger.select("ledger.failed").collect()]
    found = {(r.policy, r.rule): (r.n_kept, r.n_kept_without, r.n_failed) for r in quality.ablation(ledger).collect()}
    for policy, rules in quality.POLICIES.items():
        for rule in rules:
            counted = quality.mask(rules)
            without = counted & ~quality.BIT[rule]
            assert found[policy, rule] == (
                sum(not b & counted for b in bits),
                sum(not b & without for b in bits),
                sum(bool(b & quality.BIT[rule]) for b in bits),
            )


def test_empty_table(empty):
    assert quality.judged(empty).count() == 0
    assert quality.ablation(quality.ledger(empty.drop("ledger"))).count() == 0
