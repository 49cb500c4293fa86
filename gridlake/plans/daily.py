"""The chain of layers in one run: metadata, bronze, gate, silver, shares, gate, gold, model tests.

Stages hand over through tables only. A run works on what arrived since the last one that ended well: the dates of the
new bronze rows are the dates of silver, shares and fact that are read and rewritten, and of the shares only those that
changed are published. A gate judges the new rows, or the rewritten dates; one that fails stops the run before the next
layer is built. Every stage leaves a row in the run log, which the run-status and run-duration alerts read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import gold, keyindex, quality, silver
from gridlake.sources import readers, sinks
from gridlake.streaming.bronze import run_bronze

RUN_LOG = "run_id string, stage string, started_at timestamp, finished_at timestamp, status int, message string"
KEY = ["trading_interval", "unit_id"]
DIM_KEYS = {"dim_unit": ["unit_id"], "dim_region": ["region_id"]}
MODELS = ("fact_dispatch", *DIM_KEYS)
# The last arrival of a key wins.
NEWEST = ["arrival"]
# Digits to which a share must differ to be published again.
DIGITS = 9


@dataclass(frozen=True)
class Chain:
    """Where the chain reads and writes. ``source`` and ``target`` are options of the message reader and writer."""

    database: str
    unit_csv: str
    region_csv: str
    checkpoint: str
    source: Mapping[str, Any]
    target: Mapping[str, Any]
    fmt: str = "parquet"
    bronze_ratio: float = 1.0
    silver_ratio: float = 1.0
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def load_metadata(spark: SparkSession, chain: Chain) -> None:
    units = readers.read_metadata(spark, chain.unit_csv, schemas.UNIT_REGISTER)
    regions = readers.read_metadata(spark, chain.region_csv, schemas.REGION_REGISTER)
    sinks.replace_table(units, chain.table("unit_metadata"), fmt=chain.fmt)
    sinks.replace_table(regions, chain.table("region_metadata"), fmt=chain.fmt)


def load_bronze(spark: SparkSession, chain: Chain) -> None:
    lines = readers.message_stream(spark, **chain.source)
    run_bronze(
        spark,
        lines,
        chain.table("bronze_dispatch"),
        chain.checkpoint,
        quarantine_table=chain.table("bronze_rejected"),
        fmt=chain.fmt,
    )


@dataclass(frozen=True)
class News:
    """What a run has to do: bronze rows after ``after`` (None: all), up to ``upto``, and the dates they touch."""

    after: datetime | None
    upto: datetime | None
    dates: list[date]


def find_news(spark: SparkSession, chain: Chain, since: str | None = None) -> News:
    """The bronze rows that no finished run has seen; with ``since`` also all dates from then on.

    The filter reaches the files' statistics, so that old files are skipped. The dates are at most the partitions.
    """
    after = None
    if spark.catalog.tableExists(chain.table("progress")):
        after = spark.table(chain.table("progress")).agg(F.max("upto")).first()[0]
    rows = new_rows(spark, chain, after)
    upto = rows.agg(F.max("ingested_at")).first()[0]
    dates = {r[0] for r in rows.select("trading_date").distinct().collect()}
    if since is not None:
        bronze = spark.table(chain.table("bronze_dispatch"))
        older = bronze.where(F.col("trading_date") >= F.lit(since).cast("date")).select("trading_date").distinct()
        dates |= {r[0] for r in older.collect()}
    return News(after, upto, sorted(d for d in dates if d is not None))


def new_rows(spark: SparkSession, chain: Chain, after: datetime | None) -> DataFrame:
    rows = spark.table(chain.table("bronze_dispatch"))
    return rows if after is None else rows.where(F.col("ingested_at") > F.lit(after))


def on_dates(df: DataFrame, news: News) -> DataFrame:
    return df.where(F.col("trading_date").isin(news.dates))


def build_silver(spark: SparkSession, chain: Chain, news: News) -> None:
    """Rebuild the silver table's dates that the run touches; bronze is pruned to them."""
    rows = on_dates(spark.table(chain.table("bronze_dispatch")), news)
    name = chain.table("silver_dispatch_clean")
    clean = silver.clean_dispatch(rows, spark.table(chain.table("unit_metadata")), NEWEST, unit_order=["trading_date"])
    if spark.catalog.tableExists(name):
        sinks.overwrite_table(clean.hint("rebalance", F.col("trading_date")), name)
    else:
        sinks.replace_table(clean, name, ["trading_date"], chain.fmt)


def publish_shares(spark: SparkSession, chain: Chain, news: News) -> None:
    """Publish the shares of the written silver table that are new or changed, and keep what was published.

    A run that dies in between publishes them again: at least once, as the topic has it.
    """
    rows = on_dates(spark.table(chain.table("silver_dispatch_clean")), news)
    shares = silver.fuel_share(rows).withColumn("trading_date", F.to_date("event_time"))
    name = chain.table("published_shares")
    known = spark.catalog.tableExists(name)
    changed = shares
    if known:
        sent = on_dates(spark.table(name), news).alias("sent")
        # Sums of the same numbers in another order differ in their last digits, which is no change.
        share = lambda side: F.round(f"{side}.solar_share", DIGITS)
        same = (F.col("sent.event_time") == F.col("new.event_time")) & share("sent").eqNullSafe(share("new"))
        changed = shares.alias("new").join(sent, same, "left_anti")
    text = changed.withColumn("event_time", F.col("event_time").cast("string"))
    sinks.publish(sinks.encode_json(text, ["event_time", "solar_share"]), **chain.target)
    if known:
        sinks.overwrite_table(shares.hint("rebalance", F.col("trading_date")), name)
    else:
        sinks.replace_table(shares, name, ["trading_date"], chain.fmt)


def gate(
    spark: SparkSession, chain: Chain, layer: str, rows: DataFrame, suite: Mapping[str, Any], ratio: float
) -> None:
    found = quality.run_checkpoint(
        spark,
        f"{layer}_checkpoint",
        rows,
        suite,
        results_table=chain.table("validations"),
        run_id=f"{chain.run_id}-{layer}",
    )
    quality.check_results(found.collect(), suite["expectation_suite_name"], ratio)


def build_gold(spark: SparkSession, chain: Chain, news: News) -> dict[str, list | None]:
    """Upsert the star schema; returns the dates that each table was written at, None for all of them."""
    units = silver.dedupe(spark.table(chain.table("unit_metadata")), ["unit_id"], ["trading_date"])
    regions = silver.dedupe(spark.table(chain.table("region_metadata")), ["region_id"], ["trading_date"])
    fact = gold.fact_rows(on_dates(spark.table(chain.table("silver_dispatch_clean")), news))
    by_date = {"partition_by": ["trading_date"], "fmt": chain.fmt}
    dims = {"dim_unit": gold.dim_unit_rows(units), "dim_region": gold.dim_region_rows(regions)}
    written = {
        name: gold.build_incremental(
            spark, rows, chain.table(name), DIM_KEYS[name], "trading_date", key_moves=True, **by_date
        )
        for name, rows in dims.items()
    }
    # Corrections may lie anywhere in the touched dates, so these are upserted whole.
    written["fact_dispatch"] = gold.upsert_table(spark, chain.table("fact_dispatch"), fact, KEY, **by_date)
    return written


def check_models(spark: SparkSession, chain: Chain, written: Mapping[str, list | None] | None = None) -> None:
    """Column tests of the gold tables, and the fact's grain, on the dates that were ``written`` (None: all).

    The fact's key holds its date, so a repeated one lies in one of them. A dimension's key may also be in another
    date, and is looked for where the table's index of keys says that it may be.
    """
    found: list[Any] = []
    for model in MODELS:
        found += model_results(spark, chain.table(model), model, (written or {}).get(model)).collect()
    failed = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in found if not r["passed"]]
    fact = written_rows(spark, chain.table("fact_dispatch"), (written or {}).get("fact_dispatch"))
    repeated = quality.duplicate_counts(fact, KEY).first()["bad"]
    if repeated:
        failed.append(f"fact_dispatch grain: {repeated}")
    if failed:
        raise quality.QualityError("; ".join(failed))


def written_rows(spark: SparkSession, table: str, dates: list | None) -> DataFrame:
    rows = spark.table(table)
    return rows if dates is None else rows.where(F.col("trading_date").isin(dates))


def model_results(spark: SparkSession, table: str, model: str, dates: list | None) -> DataFrame:
    """The model's column tests on the rows of ``dates``, and of its keys on all rows that may share one."""
    tests = quality.MODEL_TESTS[model]
    rows = written_rows(spark, table, dates)
    if dates is None or model not in DIM_KEYS:
        return quality.model_tests(rows, model, tests)
    values = [t for t in tests if t["test"] != "unique"]
    unique = [t for t in tests if t["test"] == "unique"]
    rivals = keyindex.rivals(spark, table, DIM_KEYS[model], "trading_date", dates)
    return quality.model_tests(rows, model, values).unionAll(quality.model_tests(rivals, model, unique))


def run(spark: SparkSession, chain: Chain, since: str | None = None) -> DataFrame:
    """Run all stages; returns this run's log. Raises at the first failed stage, after logging it.

    ``since`` builds all dates from then on again, besides those of the new rows.
    """
    found: list[News] = []
    written: dict[str, list | None] = {}

    def silver_rows() -> DataFrame:
        return on_dates(spark.table(chain.table("silver_dispatch_clean")), found[0])

    def bronze_gate() -> None:
        rows = new_rows(spark, chain, found[0].after)
        gate(spark, chain, "bronze", rows, quality.BRONZE_SUITE, chain.bronze_ratio)

    stages: list[tuple[str, Callable[[], None]]] = [
        ("metadata", lambda: load_metadata(spark, chain)),
        ("bronze", lambda: (load_bronze(spark, chain), found.append(find_news(spark, chain, since)))),
        ("bronze_gate", bronze_gate),
        ("silver", lambda: build_silver(spark, chain, found[0])),
        ("shares", lambda: publish_shares(spark, chain, found[0])),
        ("silver_gate", lambda: gate(spark, chain, "silver", silver_rows(), quality.SILVER_SUITE, chain.silver_ratio)),
        ("gold", lambda: written.update(build_gold(spark, chain, found[0]))),
        ("model_tests", lambda: check_models(spark, chain, written)),
    ]
    log: list[tuple] = []
    try:
        for name, stage in stages:
            started, status, message = datetime.now(timezone.utc), 1, ""
            try:
                stage()
            except Exception as error:
                status, message = 0, str(error)
                raise
            finally:
                log.append((chain.run_id, name, started, datetime.now(timezone.utc), status, message))
    finally:
        frame = spark.createDataFrame(log, RUN_LOG).coalesce(1)
        frame.write.format(chain.fmt).mode("append").saveAsTable(chain.table("run_log"))
    if found[0].upto is not None:
        done = spark.createDataFrame([(chain.run_id, found[0].upto)], "run_id string, upto timestamp").coalesce(1)
        done.write.format(chain.fmt).mode("append").saveAsTable(chain.table("progress"))
    return spark.table(chain.table("run_log")).where(F.col("run_id") == chain.run_id)
