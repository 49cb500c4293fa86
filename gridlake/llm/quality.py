"""Quality rules as a ledger: every rule is evaluated once, policies and ablations only read its bits.

``ledger`` stores per document the measurements and one bit per failed rule. A policy is a mask of the rules that count;
``apply_policy`` keeps what fails none of them, and ``ablation`` says for every rule how many documents a policy would
win back without it, from a count of the (few) distinct bit patterns.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows are judged alike, each on its own
text; nothing is compared between documents; an empty table gives an empty ledger. Columns of the input stay, results
are in one struct column whose name may not be taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import SPACES, columns_of, free, small_batches

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_bangs",
)
WINDOW = 5

# Rule -> bit, in this order for ever: ledgers on disk are read by later policies.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "long_words": "word_chars > 15 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "few_letters": "100 * n_letters < 40 * word_chars",
    "shouting": "2 * n_upper > n_letters",
    "bangs": "5 * n_bangs > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")

# Versioned policies: the rules that count.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": tuple(RULES),
}

_MULTIPLIER = np.int64(0x5851F42D4C957F2D)
_SYMBOLS = b"#*$%&|<>"
_NOT_UPPER = bytes(i for i in range(256) if not 65 <= i <= 90)
# Deleting these bytes leaves ASCII letters and one (the leading) byte of each character beyond ASCII.
_NOT_LETTERS = bytes(i for i in range(256) if i < 192 and not chr(i).isalpha() or 128 <= i < 192)


def mask(rules: tuple[str, ...]) -> int:
    return sum(BIT[r] for r in rules)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window found twice or more in the text, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words))
    window = h[:n].copy()
    for k in range(1, WINDOW):
        window = window * _MULTIPLIER + h[k : k + n]
    order = np.argsort(window, kind="stable")
    ranked = window[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int32)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The values of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, SPACES))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(raw.translate(None, _NOT_LETTERS)),
        len(raw.translate(None, _NOT_UPPER)),
        raw.count(b"!"),
    )


def _measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [measure_text(value.as_py()) for value in batch]
        columns = zip(*rows, strict=True) if rows else [[] for _ in MEASURES]
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))


def measurements(text: Column) -> Column:
    measure = F.arrow_udf(_measures, ", ".join(f"{m} bigint" for m in MEASURES))
    return measure(text.cast("string"))


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with the struct ``into``: all measurements and ``failed``, the bits of the rules that the text fails."""
    if into in docs.columns:
        raise ValueError(f"the column {into} is taken")
    small_batches(docs)
    out = docs.withColumn(into, measurements(F.col(text)))
    failed = F.lit(0).cast("bigint")
    for name, rule in RULES.items():
        rule = re.sub(r"[a-z]\w+", lambda m: f"`{into}`.{m[0]}", rule)
        failed = failed.bitwiseOR(F.when(F.expr(rule), F.lit(BIT[name]).cast("bigint")).otherwise(F.lit(0)))
    return out.withColumn(into, F.col(into).withField("failed", failed))


def fails(rules: tuple[str, ...], into: str = "ledger") -> Column:
    return F.col(f"{into}.failed").bitwiseAND(F.lit(mask(rules)).cast("bigint")) != 0


def apply_policy(docs: DataFrame, version: str = "v2", into: str = "ledger") -> DataFrame:
    """The rows of a ledger that a policy keeps."""
    return docs.filter(~fails(POLICIES[version], into))


def ablation(
    docs: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES, into: str = "ledger"
) -> DataFrame:
    """``policy, rule, n_kept, n_kept_without, n_failed``: what each rule of each policy costs.

    Documents are first counted by bit pattern (at most 2 to the number of rules), the rest is bitwise arithmetic.
    """
    counts = docs.groupBy(F.col(f"{into}.failed").alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    cases = [(p, r, mask(rules), BIT[r]) for p, rules in policies.items() for r in rules]
    case = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(p).alias("policy"),
                    F.lit(r).alias("rule"),
                    F.lit(m).cast("bigint").alias("mask"),
                    F.lit(b).cast("bigint").alias("bit"),
                )
                for p, r, m, b in cases
            )
        )
    ).alias("c")
    hit = F.col("bits").bitwiseAND(F.col("c.mask"))
    without = hit.bitwiseAND(F.bitwise_not(F.col("c.bit")))
    return (
        counts.select("bits", "n", case)
        .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"),
            F.sum(F.when(without == 0, F.col("n")).otherwise(0)).alias("n_kept_without"),
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("c.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        )
    )


def judged(docs: DataFrame, version: str = "v2") -> DataFrame:
    """One row per document: its measurements, failed bits, and the verdicts of the base rules and of a policy."""
    base = fails(BASE)
    return ledger(docs.select("doc_id", "text")).select(
        "doc_id",
        *(F.col(f"ledger.{m}").alias(m) for m in MEASURES[:5]),
        base.alias("base_failed"),
        (~base & ~fails(POLICIES[version])).alias("kept"),
        F.col("ledger.failed").alias("failed_rules"),
    )


def keep_good(docs: DataFrame, version: str = "v2") -> DataFrame:
    """``docs`` without those that the policy rejects, columns unchanged."""
    into = free(docs, "ledger")
    return apply_policy(ledger(docs, into=into), version, into).select(*columns_of(docs))
