"""Secrets, with multipart credentials linked inside scopes.

Strong kinds always count: ``assign`` (a named value), ``access`` (an access key id) and ``hex`` (a long hexadecimal
run). Weak kinds are common in clean text and count only as parts of a credential: ``key`` (a long mixed token),
``endpoint`` (an address with a scheme) and ``ident`` (a named user or client). Each part opens a scope of ``SCOPE`` code
points around it, and parts are joined by overlapping intervals: a key needs an identifier in scope, an endpoint an
identifier and a secret, an identifier a secret and an endpoint.

Defined cases: a null or empty text has no spans; texts of any length are read whole, in time in proportion to their length;
repeated rows are judged alike; an empty table gives no rows; extra columns are not read by ``counted`` and stay in
``found``; a column named like its result is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import check_free, text_or_empty
from gridlake.llm.spans import State, any_case, find, fold, written_out

SCOPE = 200
STRONG = ("assign", "access", "hex")
WEAK = ("key", "endpoint", "ident")
KINDS = (*STRONG, *WEAK)

_NAMES = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_PEOPLE = "|".join(any_case(w) for w in ("user", "username", "login", "client_id", "account_id"))
_TO = r"[\"']?+\x20*+[:=]\x20*+[\"']?+"

ASSIGN = rf"(?:{_NAMES}){_TO}[A-Za-z0-9+/_.=-]++"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
KEY = r"[A-Za-z0-9+/]{40,}+"
ENDPOINT = r"https?://[A-Za-z0-9./:_-]++"
IDENT = rf"(?:{_PEOPLE}){_TO}[A-Za-z0-9@._-]++"

# Which parts a weak part needs in its scope: one of each group.
NEEDS = {
    "key": (("access", "ident"),),
    "endpoint": (("access", "ident"), ("assign", "hex", "key")),
    "ident": (("assign", "hex", "key"), ("endpoint",)),
}


def parts(text: Column) -> dict[str, Column]:
    """All candidates of each kind."""
    value = rf"^(?:{_NAMES}){_TO}(.*)$"
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    return {
        "assign": find(text, "assign", ASSIGN, None, lambda m: F.length(F.regexp_extract(m, value, 1)) >= 6),
        "access": find(text, "access", ACCESS, text.contains("AKIA")),
        "hex": find(text, "hex", HEX),
        "key": find(text, "key", KEY, None, mixed),
        "endpoint": find(text, "endpoint", ENDPOINT, text.contains("://")),
        "ident": find(text, "ident", IDENT),
    }


def linked(have: dict[str, Column], scope: int = SCOPE) -> Column:
    """A struct of the spans of each kind, of weak ones those whose complementary parts lie within their scope.

    An interval join by merging: parts of all kinds in order of their start are passed twice, forwards with the furthest
    end of each kind so far, which says whether an earlier part reaches into a scope, and backwards with the nearest start,
    which says whether a later one does.
    """
    order = {kind: n for n, kind in enumerate(KINDS)}
    keyed = [numbered(c, order[k]) for k, c in have.items()]
    # A kind that has been met nowhere is too far away.
    far = 1 << 60

    def reached(parts: Column, backwards: bool) -> Column:
        def step(state: Column, p: Column) -> tuple[State, State]:
            own = lambda k: p["n"] == order[k]
            if backwards:
                after = {k: F.when(own(k), p["s"]["start"]).otherwise(state[k]) for k in KINDS}
                near = {k: state[k] < p["s"]["end"] + scope for k in KINDS}
            else:
                after = {k: F.when(own(k), F.greatest(state[k], p["s"]["end"])).otherwise(state[k]) for k in KINDS}
                near = {k: state[k] > p["s"]["start"] - scope for k in KINDS}
            return after, {"near": F.struct(*(c.alias(k) for k, c in near.items()))}

        edge = {k: F.lit(far if backwards else -far).cast("bigint") for k in KINDS}
        kind = f"struct<{','.join(f'{k}:boolean' for k in KINDS)}>"
        return fold(F.reverse(parts) if backwards else parts, edge, step, {"near": kind})["near"]

    def complete(kind: str, part: Column) -> Column:
        needs = F.lit(True)
        for group in NEEDS.get(kind, ()):
            met = F.lit(False)
            for other in group:
                met = met | part["before"][other] | part["behind"][other]
            needs = needs & met
        return needs

    def kept(parts: Column) -> Column:
        both = F.struct(reached(parts, False).alias("before"), F.reverse(reached(parts, True)).alias("behind"))
        # Named once: the passes are not made again for every part.
        met = F.transform(
            F.array(both),
            lambda b: F.transform(
                parts, lambda p, i: F.struct(p.alias("part"), b["before"][i].alias("before"), b["behind"][i].alias("behind"))
            ),
        )[0]

        def split(all_: Column) -> Column:
            def of(kind: str) -> Column:
                mine = F.filter(all_, lambda x: (x["part"]["n"] == order[kind]) & complete(kind, x))
                return F.transform(mine, lambda x: x["part"]["s"]).alias(kind)

            return F.struct(*map(of, KINDS))

        return F.transform(F.array(met), split)[0]

    return F.transform(F.array(F.array_sort(F.concat(*keyed))), kept)[0]


def found(docs: DataFrame, into: str = "secrets", scope: int = SCOPE) -> DataFrame:
    """``docs`` with the struct ``into``: one array of spans per kind."""
    check_free(docs, into)
    rows = docs.withColumn(into, F.struct(*(c.alias(k) for k, c in parts(text_or_empty()).items())))
    return rows.withColumn(into, linked({k: F.col(f"{into}.{k}") for k in KINDS}, scope))


def by_place(columns: list[Column]) -> Column:
    """Spans of several kinds by start, then by kind as given."""
    keyed = (numbered(c, n) for n, c in enumerate(columns))
    return F.transform(F.array_sort(F.concat(*keyed)), lambda x: x["s"])


def numbered(spans: Column, n: int) -> Column:
    """Spans with their start and the number of their kind, by which they are sorted."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("n"), s.alias("s")))


def counted(docs: DataFrame) -> DataFrame:
    """Per document the number of spans of the strong kinds, a digest of them, and all spans written out."""
    rows = found(docs.select("doc_id", "text"))
    have = {k: F.col(f"secrets.{k}") for k in KINDS}
    return rows.select(
        "doc_id",
        *(F.size(have[k]).cast("bigint").alias(f"n_{k}") for k in STRONG),
        F.sha2(written_out(by_place([have[k] for k in STRONG])).cast("binary"), 256).alias("base_sha256"),
        written_out(by_place([have[k] for k in KINDS])).alias("spans"),
    )
