"""Small documents with every case that the operators define: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, ledger string, "
    "match0 string, node string, label string, size string, place string, _lost string, _id bigint, _kept string, "
    "wins string, ratios string, _mix_place string, _pii string, target string, shard string"
)


def sentence(rng: random.Random, words: int, letters: str = "abcdefghij") -> str:
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """``doc_id, text, source``."""
    rng = random.Random(4)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    other = sentence(rng, 80)
    line = "Shared boilerplate line of the site"
    lines = [sentence(rng, 12) for _ in range(6)]
    return [
        (1, base, "a"),
        (2, " ".join(near), "a"),
        (3, base, "b"),
        (4, other, None),
        (5, None, "a"),
        (6, "", "b"),
        (7, " \t\n\x0b ", "c"),
        (8, sentence(rng, 6000), "a"),
        (9, "one two three", "c"),
        (10, "one two three", "c"),
        (11, line + "\n" + "\n".join(lines[:3]), "a"),
        (12, "\n".join(lines[3:]) + "\n  " + line.upper() + " \n" + line, "b"),
        (13, line + "\nshort\nshort\n" + line, "b"),
        (14, "\n".join(["Again and again the same words"] * 9), "a"),
        (15, "x### " * 40, "a"),
        (16, "Ünï çödé \U0001f600 " * 30 + "été", "d"),
        (None, base, None),
        (None, other + " more words here", "a"),
        (1, base, "a"),
        (4, other, None),
        (17, "the the the " * 30, "a"),
    ]


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    full = [
        (i, t, "en" if k % 2 else None, s, None if t is None else len(t), *("7" if k % 3 else None for _ in names[6:]))
        for k, (i, t, s) in enumerate(rows)
    ]
    full = [(*r[:5], 3, *r[5:]) for r in full]
    at = names.index("_id")
    full = [tuple((int(v) if v else None) if k == at else v for k, v in enumerate(r)) for r in full]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
