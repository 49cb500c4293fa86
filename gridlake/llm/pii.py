"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Kinds, in order: ``email``, ``ip``, ``card`` (Luhn), ``phone``, which always count; ``iban`` (mod-97); ``ssn``, whose
pattern alone is too weak, so that it counts only with a context word within ``REACH`` code points before or after it.
Every span has a score between 0 and 1: the kind's prior, raised by a context word of the kind. Matches of a kind with
neither letters nor digits between them (a list) share the words before the first and after the last.

Patterns are written so that no match attempt runs over a stretch more than once (possessive quantifiers, a start only
where the stretch before it ends): long runs of letters or digits cost linear time, and deep recursion cannot occur.

Defined cases: a null or empty text has no spans; texts of any length are read whole, in time in proportion to their length;
repeated rows are judged alike; an empty table gives no rows; extra columns are not read by ``counted`` and stay in
``found`` and ``redact``; a column named like the result of ``found`` is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import check_free, free, text_or_empty
from gridlake.llm.spans import MARK, OTHER, State, any_case, digits, find, fold, written_out

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}(?:\.{_LABEL})++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Where an account number can begin, and one of a country without a length below.
IBAN_START = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){8}"
IBAN = r"[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"

IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_COUNTRY = f"^(?:{'|'.join(c for names in IBAN_LENGTHS.values() for c in names.split())})"
IBAN_EXACT = "|".join(
    f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items()
)

BASE = ("email", "ip", "card", "phone")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.9, "ssn": 0.3}
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social security"),
}
RAISE = 0.3
REACH = 40
NEEDED = 0.5
# Code points of the blocks from which ``redact`` puts a text together.
STRETCH = 4096


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, -i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an account number without blanks leaves 1 when read, first four last, as a number modulo 97."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def add(rest: Column, i: Column) -> Column:
        sign = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(sign < 65, (rest * 10 + sign - 48) % 97).otherwise((rest * 100 + sign - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def iban_length(ahead: Column) -> Column:
    """Code points of the valid account number that ``ahead`` begins with, 0 without one.

    A number of a known country has that country's length. Else mod-97 chooses: the longest proposal, and where the
    country is not known, one that ends at an earlier blank.
    """
    words = F.split(F.regexp_extract(ahead, f"^(?:{IBAN})", 0), " ")
    known = ahead.rlike(IBAN_COUNTRY)

    def proposals(words: Column) -> Column:
        fewer = F.sequence(F.lit(0), F.when(known, 0).otherwise(F.greatest(F.size(words) - 3, F.lit(0))))
        return F.transform(fewer, lambda k: F.array_join(F.slice(words, 1, F.size(words) - k), " "))

    exact = F.array(F.regexp_extract(ahead, f"^(?:{IBAN_EXACT})", 0))
    every = F.concat(exact, F.transform(F.array(words), proposals)[0])
    valid = F.filter(every, lambda m: (m != "") & mod_97(F.replace(m, F.lit(" "), F.lit(""))))
    return F.coalesce(F.length(F.get(valid, F.lit(0))), F.lit(0))


def marked_ibans(text: Column) -> Column:
    """``text`` with marks around its account numbers. Every place where one can begin is tried, from left to right, so
    that a proposal that fails hides none that begins inside it."""
    length = F.length
    start = {"n": F.lit(0), "left": F.lit(0)}

    def marks(pieces: Column) -> Column:
        def step(state: Column, piece: Column) -> tuple[State, State]:
            # Places are at least four code points apart, and a number with blanks has at most 68.
            ahead = F.substring(F.array_join(F.slice(pieces, state["n"] + 1, 18), ""), 1, 68)

            def placed(own: Column) -> Column:
                # ``left`` is what this piece holds of a number, at most all of it; the rest lies in the next pieces.
                left = F.when(state["left"] > 0, state["left"]).otherwise(own)
                begun = F.when(own > 0, F.concat(F.lit(MARK), piece)).otherwise(piece)
                at = left + F.when(own > 0, 1).otherwise(0)
                ended = F.concat(F.substring(begun, F.lit(1), at), F.lit(MARK), F.substring(begun, at + 1, length(begun)))
                inside = (left > 0) & (left <= length(piece))
                return F.struct(
                    F.when(left > length(piece), left - length(piece)).otherwise(0).alias("left"),
                    F.when(inside, ended).otherwise(begun).alias("out"),
                )

            own = F.when((state["left"] == 0) & piece.rlike("^[A-Z]{2}[0-9]{2}"), iban_length(ahead)).otherwise(0)
            made = F.transform(F.array(own), placed)[0]
            return {"n": state["n"] + 1, "left": made["left"]}, {"out": made["out"]}

        return F.array_join(fold(pieces, start, step, {"out": "string"})["out"], "")

    pieces = F.split(F.translate(text, MARK, OTHER), f"(?={IBAN_START})", -1)
    return F.transform(F.array(pieces), marks)[0]


def scored(kind: str):
    words = "|".join(any_case(w) for w in CONTEXT[kind])

    def score(before: Column, after: Column) -> Column:
        near = before.rlike(words) | after.rlike(words)
        points = F.least(F.lit(PRIOR[kind]) + F.when(near, RAISE).otherwise(0.0), F.lit(1.0))
        return points if kind in BASE else F.when(points >= NEEDED, points)

    return score


def spans(text: Column) -> dict[str, Column]:
    """The spans of each kind."""
    length = F.length

    def of(kind: str, pattern: str, hint: Column | None = None, valid=None, marked: Column | None = None) -> Column:
        return find(text, kind, pattern, hint, valid, scored(kind), REACH, marked)

    return {
        "email": of("email", EMAIL, text.contains("@")),
        "ip": of("ip", IP, None, lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        "card": of(
            "card",
            CARD,
            text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
            lambda m: length(digits(m)).between(16, 19) & luhn(digits(m)),
        ),
        "phone": of("phone", PHONE, text.contains("+"), lambda m: length(digits(m)).between(8, 15)),
        "iban": of("iban", IBAN_START, None, None, marked_ibans(text)),
        "ssn": of("ssn", SSN),
    }


def found(docs: DataFrame, into: str = "pii") -> DataFrame:
    """``docs`` with the struct ``into``: one array of spans per kind."""
    check_free(docs, into)
    return docs.withColumn(into, F.struct(*(c.alias(k) for k, c in spans(text_or_empty()).items())))


def counted(docs: DataFrame) -> DataFrame:
    """Per document the number of spans of the base kinds, a digest of them, and all spans written out."""
    kinds = spans(text_or_empty())
    rows = docs.select("doc_id", *(c.alias(f"s_{k}") for k, c in kinds.items()))
    base = F.concat(*(F.col(f"s_{k}") for k in BASE))
    every = F.concat(*(F.col(f"s_{k}") for k in kinds))
    return rows.select(
        "doc_id",
        *(F.size(f"s_{k}").cast("bigint").alias(f"n_{k}") for k in BASE),
        F.sha2(written_out(base).cast("binary"), 256).alias("base_sha256"),
        written_out(every).alias("spans"),
    )


def redact(docs: DataFrame, least: float = NEEDED) -> DataFrame:
    """``docs`` with every span of at least that score in ``text`` replaced by its kind; overlaps become the first."""
    into = free(docs, "pii")
    every = F.filter(F.concat(*spans(text_or_empty()).values()), lambda s: s["score"] >= least)
    order = F.array_sort(
        F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    text = F.col("text").cast("string")

    def replaced(found: Column) -> Column:
        def between(blocks: Column, low: Column, high: Column) -> Column:
            """Code points of the text, from the blocks that hold them."""
            first = F.floor(low / STRETCH)
            chosen = F.slice(blocks, (first + 1).cast("int"), (F.ceil(high / STRETCH) - first).cast("int"))
            inside = F.substring(F.array_join(chosen, ""), (low - first * STRETCH + 1).cast("int"), (high - low).cast("int"))
            return F.when(high > low, inside).otherwise("")

        def written(blocks: Column) -> Column:
            def step(state: Column, s: Column) -> tuple[State, State]:
                told = F.concat(between(blocks, state["at"], s["start"]), F.lit("<"), s["kind"], F.lit(">"))
                return (
                    {"at": F.greatest(state["at"], s["end"])},
                    {"out": F.when(s["start"] >= state["at"], told)},
                )

            done = fold(found, {"at": F.lit(0).cast("bigint")}, step, {"out": "string"})
            length = F.length(text).cast("bigint")
            return F.transform(
                F.array(done), lambda d: F.concat(F.array_join(d["out"], ""), between(blocks, d["state"]["at"], length))
            )[0]

        return F.transform(F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))), written)[0]

    done = F.transform(F.array(F.col(into)), replaced)[0]
    return (
        docs.withColumn(into, order)
        .withColumn("text", F.when(F.size(into) > 0, done).otherwise(F.col("text")))
        .drop(into)
    )
