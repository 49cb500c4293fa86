"""URL filter: rules on host and path, and for the rest a character language-model ratio.

URLs that a rule accepts or rejects train two Markov models over a 32-sign alphabet (letters, one sign for digits, the
usual punctuation, one for anything else, one for the edge). The order varies: Witten-Bell smoothing mixes contexts of
``ORDER`` signs with shorter ones, by how many different signs followed them. The difference of the log likelihoods,
divided by the length, is compared with a threshold; it is the one, on a held-out fourth of the trained URLs, with the
largest sum of the shares of both classes judged right.

A model is dense, ``32 ** (ORDER + 1)`` numbers whatever the data, so scoring a URL is array lookups in its own row: no
URL's signs are shuffled to be scored, and what is sent to the tasks has a fixed size.

The models read the whole URL behind its scheme, query and fragment too; host and path are for the rules and the result.

Defined cases: a URL without ``://`` has empty host and path, fits no rule, and is judged as it is; a null URL likewise,
as an empty string; repeated rows are judged alike; without accepted or without rejected URLs the ratio is that of the class there
is against even odds, and the threshold 0; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.common import A_TO_Z, LOWER, written

ORDER = 3
SIGNS = 32
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BIN = 0.01


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, A_TO_Z, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def signs_of(url: Column) -> Column:
    """What the models read: all behind the scheme, or all of a URL that has none."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), "^[^/?#]*?://", "")


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host, path``, the longest fitting ``rule`` and its ``ruling`` (both null without one)."""
    out = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((F.col("host") == name) | F.col("host").endswith(f".{name}")) & F.col("path").startswith(f"/{rest}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        ruling = F.when(fits, F.lit(action)).otherwise(ruling)
    return out.withColumn("rule", rule).withColumn("ruling", ruling)


def grams(text: Column, order: int = ORDER) -> Column:
    """Each sign with the ``order`` signs before it, as one number; an edge sign begins and ends the text."""
    kept = F.regexp_replace(F.translate(text, A_TO_Z, LOWER), "[^a-z0-9./_-]", "\x7f")
    signs = F.split(F.concat(F.lit("`" * order), F.translate(kept, "0123456789./-_", "{{{{{{{{{{|}~~"), F.lit("`")), "")
    numbers = F.transform(signs, lambda c: F.ascii(c) - 96)

    def windows(numbers: Column) -> Column:
        at = F.sequence(F.lit(order + 1), F.size(numbers))
        return F.transform(at, lambda i: sum(F.get(numbers, i - 1 - k) * SIGNS**k for k in range(order + 1)))

    # As a lambda's variable the numbers are made once for the text and not again for every window.
    return F.transform(F.array(numbers), windows)[0]


def train(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio`` for every possible gram, from ``grams`` (an array) and ``accepted`` (a boolean)."""
    one = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    counted = (
        labelled.select("accepted", F.explode("grams").alias("gram"))
        .groupBy("accepted", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("gram")
        .agg(one(F.col("accepted")).alias("a"), one(~F.col("accepted")).alias("r"))
    )
    counted = written(counted, "url-grams")
    spark = labelled.sparkSession
    even = F.lit(1.0 / SIGNS)
    below = None
    for k in range(order + 1):
        size = SIGNS ** (k + 1)
        counts = counted.groupBy((F.col("gram") % size).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        all_grams = spark.range(size).select(F.col("id").cast("int").alias("gram")).join(counts, "gram", "left")
        if below is not None:
            shorter = below.select(F.col("gram").alias("short"), F.col("pa").alias("qa"), F.col("pr").alias("qr"))
            all_grams = all_grams.join(shorter, F.col("gram") % (size // SIGNS) == F.col("short"))
        else:
            all_grams = all_grams.withColumn("qa", even).withColumn("qr", even)
        context = Window.partitionBy(F.floor(F.col("gram") / SIGNS))

        def smoothed(n: str, q: str, context=context) -> Column:
            times = F.coalesce(F.col(n), F.lit(0))
            followers = F.sum((times > 0).cast("int")).over(context)
            seen = F.sum(times).over(context)
            return F.when(seen > 0, (times + followers * F.col(q)) / (seen + followers)).otherwise(F.col(q))

        below = all_grams.select("gram", smoothed("a", "qa").alias("pa"), smoothed("r", "qr").alias("pr"))
    return below.select("gram", (F.log("pa") - F.log("pr")).alias("ratio"))


def as_array(model: DataFrame) -> DataFrame:
    """The model's one row: its ratios by gram. Its length is fixed by the order."""
    rows = F.array_sort(F.collect_list(F.struct("gram", "ratio")))
    return model.agg(F.transform(rows, lambda r: r["ratio"]).alias("ratios"))


def mean_ratio(codes: Column, ratios: Column) -> Column:
    # Named once, so that the optimizer puts grams and ratios in place and no row carries a copy of the model.
    mean = lambda c: F.aggregate(c, F.lit(0.0), lambda s, g: s + F.get(ratios, g)) / F.size(c)
    return F.transform(F.array(codes), mean)[0]


def threshold(scored: DataFrame) -> float:
    """The lower edge of the score bin from which on accepting judges the largest shares of both classes right."""
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.sum(F.col("accepted").cast("int")).alias("a"), F.sum((~F.col("accepted")).cast("int")).alias("r")
    )
    from_here = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = lambda c: F.try_divide(F.sum(c).over(from_here), F.sum(c).over(whole))
    right = share("a") - share("r")
    best = bins.withColumn("right", right).filter("right is not null").orderBy(F.desc("right"), "bin").select("bin").first()
    return best["bin"] * BIN if best else 0.0


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """Per page: host, path, the rule that fits, and the verdict of the rule or else of the model."""
    rows = ruled(pages.select("page_id", "url"), rules).withColumn("grams", grams(signs_of(F.col("url")), order))
    labelled = rows.filter("ruling is not null").select(
        (F.col("ruling") == "allow").alias("accepted"),
        "grams",
        F.substring(F.md5(F.col("url").cast("binary")), 1, 1).isin(*"0123").alias("held"),
    )
    model = written(as_array(train(labelled.filter("not held"), order)), "url-model")
    score = mean_ratio(F.col("grams"), F.col("ratios"))
    with_model = lambda df: df.withColumn("ratios", model.scalar())
    least = threshold(with_model(labelled.filter("held")).select("accepted", score.alias("score")))
    opinion = F.when(score >= least, "allow").otherwise("block")
    verdict = F.coalesce("ruling", opinion).alias("verdict")
    return with_model(rows).select("page_id", "host", "path", "rule", verdict)
