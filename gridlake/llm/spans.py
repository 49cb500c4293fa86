"""Places of pattern matches as column expressions: no Python on the executors.

A text's matches are put between markers and the text is split there, so that matches are the odd pieces and places are
sums of lengths. The marker is a control character; where the text itself has it, another one stands in, which no
pattern here contains either.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK, OTHER = "\x01", "\x02"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


# Items that a fold takes before it puts their results aside: an array grows by copying, and so must stay short.
BLOCK = 128

State = dict[str, Column]


def fold(
    items: Column, start: State, step: Callable[[Column, Column], tuple[State, State]], emitted: dict[str, str]
) -> Column:
    """A struct of the last state and of an array for each name in ``emitted`` (with its elements' type).

    ``step(state, item)`` gives the next state and what it emits, NULL for nothing. Time is in proportion to the items:
    they are folded in blocks, and a block's arrays are put into one array of arrays.
    """

    def packed(state: State) -> Column:
        return F.struct(*(c.alias(k) for k, c in state.items()))

    def none(name: str) -> Column:
        return F.array().cast(f"array<{emitted[name]}>")

    def inner(acc: Column, item: Column) -> Column:
        after, out = step(acc["state"], item)
        made = F.struct(packed(after).alias("state"), *(c.alias(k) for k, c in out.items()))

        def added(found: Column) -> Column:
            arrays = (
                F.when(found[k].isNotNull(), F.concat(acc[k], F.array(found[k].cast(kind)))).otherwise(acc[k]).alias(k)
                for k, kind in emitted.items()
            )
            return F.struct(found["state"].alias("state"), *arrays)

        # Named once: what a step computes is used for each of its results.
        return F.transform(F.array(made), added)[0]

    def outer(acc: Column, block: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), *(none(k).alias(k) for k in emitted))

        def aside(found: Column) -> Column:
            arrays = (F.concat(acc[k], F.array(found[k])).alias(k) for k in emitted)
            return F.struct(found["state"].alias("state"), *arrays)

        return F.transform(F.array(F.aggregate(block, begin, inner)), aside)[0]

    def whole(found: Column) -> Column:
        return F.struct(found["state"].alias("state"), *(F.flatten(found[k]).alias(k) for k in emitted))

    def all_of(each: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(each) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(each, b * BLOCK + 1, F.lit(BLOCK)))
        empty = (F.array().cast(f"array<array<{kind}>>").alias(k) for k, kind in emitted.items())
        return F.aggregate(blocks, F.struct(packed(start).alias("state"), *empty), outer, whole)

    nothing = F.struct(packed(start).alias("state"), *(none(k).alias(k) for k in emitted))
    return F.transform(F.array(items), lambda each: F.when(F.size(each) > 0, all_of(each)).otherwise(nothing))[0]


def find(
    text: Column,
    kind: str,
    pattern: str,
    hint: Column | None = None,
    valid: Callable[[Column], Column] | None = None,
    score: Callable[[Column, Column], Column] | None = None,
    reach: int = 0,
    marked: Column | None = None,
) -> Column:
    """The leftmost non-overlapping matches of ``pattern`` that are ``valid``, as ``SPAN`` in order of place.

    ``hint`` is a cheap condition that every text with a match meets. Matches with neither letters nor digits and at most
    ``reach`` code points between them are a list. ``score`` gets the ``reach`` code points of the text before the list
    and those after it; a null score drops its spans. Places are code points, the end exclusive. ``marked`` is the text
    with marks around other matches than the leftmost.
    """
    if marked is None:
        marked = F.regexp_replace(F.translate(text, MARK, OTHER), F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))
    start = {
        "at": F.lit(0).cast("bigint"),
        "n": F.lit(0),
        "tail": F.lit(""),
        "before": F.lit(""),
        "inside": F.lit(False),
        "list": F.lit(0),
        "hits": F.lit(0),
    }
    emitted = {"span": "struct<start:bigint,end:bigint,list:int>"} | ({"list": "struct<points:double>"} if score else {})

    def spans_of(pieces: Column) -> Column:
        def step(state: Column, piece: Column) -> tuple[State, State]:
            match = state["n"] % 2 == 1
            end = state["at"] + F.length(piece)
            passes = match & (valid(piece) if valid else F.lit(True))
            span = F.struct(state["at"].alias("start"), end.alias("end"), state["list"].alias("list"))
            # Without a score nothing depends on lists.
            short = F.lit(score is not None) & (F.length(piece) <= reach) & (state["n"] + 1 < F.size(pieces))
            ends = ~match & ~(short & ~piece.rlike(r"[\p{L}\p{N}]"))
            told = ends & (state["hits"] > 0)
            after: State = {
                "at": end,
                "n": state["n"] + 1,
                "tail": F.substring(F.concat(state["tail"], F.substring(piece, -reach, reach)), -reach, reach),
                "before": F.when(match & ~state["inside"], state["tail"]).otherwise(state["before"]),
                "inside": F.when(match, True).when(ends, False).otherwise(state["inside"]),
                "list": state["list"] + told.cast("int"),
                "hits": F.when(ends, 0).otherwise(F.when(passes, 1).otherwise(state["hits"])),
            }
            out: State = {"span": F.when(passes, span)}
            if score:
                # Every match is at least one code point long, so that the reach lies in so many pieces.
                near = F.transform(F.slice(pieces, state["n"] + 1, 2 * reach + 1), lambda p: F.substring(p, 1, reach))
                points = score(state["before"], F.substring(F.array_join(near, ""), 1, reach))
                out["list"] = F.when(told, F.struct(points.cast("double").alias("points")))
            return after, out

        def scored(found: Column) -> Column:
            points = (lambda s: found["list"][s["list"]]["points"]) if score else lambda s: F.lit(1.0)
            every = F.transform(
                found["span"], lambda s: F.struct(F.lit(kind), s["start"], s["end"], points(s)).cast(SPAN[6:-1])
            )
            return F.filter(every, lambda s: s["score"].isNotNull()) if score else every

        return F.transform(F.array(fold(pieces, start, step, emitted)), scored)[0]

    # As a lambda's variable the pieces are made once for the text and not again for every match.
    found = F.transform(F.array(F.split(marked, MARK, -1)), spans_of)[0]
    return F.when(hint if hint is not None else text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def written_out(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digits(piece: Column) -> Column:
    return F.regexp_replace(piece, "[^0-9]", "")


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
