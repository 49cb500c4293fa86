"""One query per operator over the given tables. Each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas
from gridlake.functions.payloads import parse_json, parse_shares
from gridlake.operators import alerts, bronze, feed, forecast, gold, metrics, quality, silver
from gridlake.operators.lookup import lookup_join
from gridlake.operators.ordered import bucket_width
from gridlake.plans import daily
from gridlake.plans.views import dispatch, payloads, regions, table, units
from gridlake.session import apply_settings, scratch_dir, settings
from gridlake.sources import readers, sinks
from gridlake.streaming import alerts as stream_alerts
from gridlake.streaming import bronze as stream_bronze
from gridlake.streaming import compaction, late
from gridlake.streaming import feed as stream_feed
from gridlake.streaming import forecast as stream_forecasts
from gridlake.streaming import rates as stream_rates
from gridlake.streaming import tables as stream_tables
from gridlake.streaming.runner import start

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEY = ["trading_interval", "unit_id"]
ORDER = ["ingested_at", "event_id"]
MESSAGE = ["trading_interval", "unit_id", "generated_mw", "fuel_type"]
NTZ_MESSAGE = schemas.with_ntz(schemas.DISPATCH_MESSAGE)


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_settings(spark), sf_dir)

    REGISTRY[function.__name__] = run
    return run


def rounded(value: Column | str, digits: int = 6) -> Column:
    # Adding zero turns -0.0 into 0.0.
    return F.round(value, digits) + F.lit(0.0)


def new_database(spark: SparkSession) -> str:
    """An empty database whose tables lie in the shared scratch folder."""
    name = f"gridlake_{uuid.uuid4().hex[:12]}"
    return sinks.ensure_database(spark, name, scratch_dir(spark, name))


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedupe(dispatch(spark, sf_dir), KEY, ORDER)


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.clean_dispatch(dispatch(spark, sf_dir), units(spark, sf_dir), ORDER)
    return rows.withColumn("trading_date", F.to_date("trading_interval"))


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fuel_share(deduped(spark, sf_dir))


def coal_percent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.label_share(deduped(spark, sf_dir), ["trading_interval"], "fuel_type", "coal", "generated_mw")


# --- silver -----------------------------------------------------------------------------------------------------------


@query
def dedupe_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduped(spark, sf_dir).select(*MESSAGE)


@query
def enrich_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.clean_dispatch(dispatch(spark, sf_dir), units(spark, sf_dir), ORDER)
    return rows.select(*MESSAGE, "station_name")


@query
def solar_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(spark, sf_dir).select("event_time", rounded("solar_share").alias("solar_share"))


@query
def solar_share_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = silver.fuel_share(deduped(spark, sf_dir), fill_zero=True)
    return found.select("event_time", rounded("solar_share").alias("solar_share"))


# --- messages and files -----------------------------------------------------------------------------------------------


@query
def csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sinks.encode_csv(dispatch(spark, sf_dir), MESSAGE)
    good, _ = bronze.parse_dispatch(lines, NTZ_MESSAGE)
    return good.drop("ingested_at")


@query
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, damaged according to its own values, with the verdict of the quarantine."""
    rows = dispatch(spark, sf_dir)
    line = F.to_csv(F.struct(*MESSAGE))
    damaged = (
        F.when(F.col("generated_mw") > 200, F.concat(line, F.lit(",extra")))
        .when(F.col("generated_mw") < 2, F.concat_ws(",", "trading_interval", "unit_id"))
        .when(F.col("fuel_type") == "Hydro", F.concat_ws(",", F.lit("bad"), "unit_id", F.lit("1"), "fuel_type"))
        .when(F.col("fuel_type") == "Wind", F.concat_ws(",", "trading_interval", "unit_id", F.lit("xx"), "fuel_type"))
        .otherwise(line)
    )
    parsed = bronze.parse_messages(rows.select("event_id", damaged.alias("value")), NTZ_MESSAGE)
    return parsed.select("event_id", *MESSAGE, bronze.is_quarantined().alias("quarantined"))


# Column orders of the landed documents; they hold columns of their own beside those of the message.
HEADERS = [
    ["fuel_type", "event_id", "generated_mw", "unit_id", "trading_interval"],
    ["trading_interval", "unit_id", "ingested_at", "fuel_type", "generated_mw"],
]


@query
def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land CSV documents with other columns, in two orders, pick by name, and send one CSV line per record."""
    folder = scratch_dir(spark, "landing")
    rows = dispatch(spark, sf_dir)
    for part, header in enumerate(HEADERS):
        half = rows.where(F.col("event_id") % len(HEADERS) == part)
        half.select(*header).write.option("header", True).mode("append").csv(folder)
    picked = readers.landing_feed(spark, folder, NTZ_MESSAGE)
    lines = sinks.encode_csv(picked, MESSAGE, key="unit_id")
    good, _ = bronze.parse_dispatch(lines, NTZ_MESSAGE)
    return good.select("key", *MESSAGE)


@query
def solar_share_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the shares as JSON messages and read the messages back."""
    folder = scratch_dir(spark, "share-topic")
    rows = shares(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("string"))
    sinks.publish(sinks.encode_json(rows, ["event_time", "solar_share"]), "text", folder)
    received = parse_json(readers.messages(spark, "text", folder), schemas.SHARE_MESSAGE)
    return received.select("event_time", rounded("solar_share").alias("solar_share"))


@query
def share_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shares(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("string"))
    lines = sinks.encode_json(rows, ["event_time", "solar_share"])
    used = parse_shares(lines, schemas.SHARE_MESSAGE, "event_time", "solar_share", zoneless=True)
    return used.select("event_time", rounded("solar_share").alias("solar_share"))


@query
def metadata_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit and region CSV files into their tables."""
    folder, database = scratch_dir(spark, "metadata"), new_database(spark)
    unit_columns = [f.name for f in schemas.UNIT_METADATA]
    region_columns = [f.name for f in schemas.REGION_METADATA]
    units(spark, sf_dir).select(*unit_columns).write.option("header", True).csv(f"{folder}/units")
    regions(spark, sf_dir).select(*region_columns).write.option("header", True).csv(f"{folder}/regions")
    unit_table, region_table = f"{database}.unit_metadata", f"{database}.region_metadata"
    sinks.replace_table(readers.read_metadata(spark, f"{folder}/units", schemas.UNIT_METADATA), unit_table)
    sinks.replace_table(readers.read_metadata(spark, f"{folder}/regions", schemas.REGION_METADATA), region_table)
    found = spark.table(unit_table).select(
        F.lit("unit").alias("kind"), F.col("unit_id").alias("id"), F.col("station_name").alias("name"), "fuel_type"
    )
    return found.unionByName(
        spark.table(region_table).select(
            F.lit("region").alias("kind"),
            F.col("region_id").alias("id"),
            F.col("region_name").alias("name"),
            F.lit(None).cast("string").alias("fuel_type"),
        )
    )


@query
def silver_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze table to silver table, and the share of the written rows next to each row."""
    database = new_database(spark)
    bronze_rows = dispatch(spark, sf_dir).withColumn("trading_date", F.to_date("trading_interval"))
    sinks.replace_table(bronze_rows, f"{database}.bronze_dispatch", ["trading_date"])
    clean = silver.clean_dispatch(spark.table(f"{database}.bronze_dispatch"), units(spark, sf_dir), ORDER)
    sinks.replace_table(clean, f"{database}.silver_dispatch_clean", ["trading_date"])
    written = spark.table(f"{database}.silver_dispatch_clean")
    found = silver.fuel_share(written, time_name="trading_interval")
    return lookup_join(written, found, ["trading_interval"], ["solar_share"], small=False, unique=True).select(
        *MESSAGE, "trading_date", "station_name", rounded("solar_share").alias("solar_share")
    )


# --- gold -------------------------------------------------------------------------------------------------------------

FIRST_LOAD_END = "2024-01-15"


def first_load(df: DataFrame) -> DataFrame:
    """The rows an earlier load had seen."""
    return df.where(F.col("trading_date") < F.lit(FIRST_LOAD_END).cast("date"))


@query
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.fact_rows(silver_rows(spark, sf_dir))
    return gold.incremental_slice(rows, first_load(rows), "trading_interval")


@query
def incremental_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice with two days of lookback; rows the plain bound would miss are marked late."""
    rows = gold.fact_rows(silver_rows(spark, sf_dir))
    loaded = first_load(rows)
    wide = gold.incremental_slice(rows, loaded, "trading_interval", lookback="2 days")
    late = gold.late_rows(wide, loaded, "trading_interval").withColumn("late", F.lit(True))
    return late.unionByName(gold.incremental_slice(wide, loaded, "trading_interval").withColumn("late", F.lit(False)))


@query
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, then an increment whose readings are corrected by +1, replayed once."""
    database = new_database(spark)
    fact = f"{database}.fact_dispatch"
    rows = gold.fact_rows(silver_rows(spark, sf_dir))
    options = {"keys": KEY, "column": "trading_interval", "partition_by": ["trading_date"]}
    options["date_column"] = "trading_date"
    gold.build_incremental(spark, first_load(rows), fact, **options)
    corrected = rows.withColumn("generated_mw", F.col("generated_mw") + 1)
    gold.build_incremental(spark, corrected, fact, **options)
    gold.build_incremental(spark, corrected, fact, **options)
    return spark.table(fact).select(*MESSAGE, "trading_date")


def _dim_upsert(spark: SparkSession, rows: DataFrame, key: str, name: str) -> DataFrame:
    model = f"{new_database(spark)}.dim"
    options = {"keys": [key], "column": "trading_date", "partition_by": ["trading_date"], "key_moves": True}
    gold.build_incremental(spark, first_load(rows), model, **options)
    renamed = rows.withColumn(name, F.concat(name, F.lit("_v2")))
    gold.build_incremental(spark, renamed, model, **options)
    return spark.table(model)


@query
def dim_unit_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_upsert(spark, gold.dim_unit_rows(units(spark, sf_dir)), "unit_id", "unit_name")


@query
def dim_region_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_upsert(spark, gold.dim_region_rows(regions(spark, sf_dir)), "region_id", "region_name")


@query
def generation_by_unit_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = gold.generation_by_unit_fuel(dispatch(spark, sf_dir))
    return found.withColumn("generated_mw", rounded("generated_mw", 4))


@query
def star_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = gold.fact_rows(silver_rows(spark, sf_dir))
    found = gold.star_generation(
        fact, gold.dim_unit_rows(units(spark, sf_dir)), gold.dim_region_rows(regions(spark, sf_dir))
    )
    return found.withColumn("generated_mw", rounded("generated_mw", 4))


def daily_chain(spark: SparkSession, sf_dir: str, **options: object) -> tuple[str, daily.Chain]:
    """A chain over the given units and regions, and the folder of its message log and topics."""
    root, database = scratch_dir(spark, "daily"), new_database(spark)
    unit_columns = [f.name for f in schemas.UNIT_REGISTER]
    region_columns = [f.name for f in schemas.REGION_REGISTER]
    units(spark, sf_dir).select(*unit_columns).write.option("header", True).csv(f"{root}/units")
    regions(spark, sf_dir).select(*region_columns).write.option("header", True).csv(f"{root}/regions")
    return root, daily.Chain(
        database=database,
        unit_csv=f"{root}/units",
        region_csv=f"{root}/regions",
        checkpoint=f"{root}/checkpoint",
        source={"fmt": "parquet", "path": f"{root}/topic"},
        target={"fmt": "text", "path": f"{root}/shares"},
        **options,
    )


def send(rows: DataFrame, topic: str) -> None:
    """Dispatch rows as messages of a log; the event is the offset, its time that of the message."""
    log = rows.select(
        F.col("unit_id").alias("key"),
        F.to_csv(F.struct(*MESSAGE)).alias("value"),
        F.lit("dispatch").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ingested_at").cast("timestamp").alias("timestamp"),
    )
    log.write.mode("append").parquet(topic)


@query
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from messages and files to the star schema, with both gates; the fact with its unit and region.

    The gate of the raw layer wants unique keys, so the feed sends the last reading of each.
    """
    root, chain = daily_chain(spark, sf_dir)
    send(deduped(spark, sf_dir), f"{root}/topic")
    daily.run(spark, chain)
    tables = [spark.table(chain.table(name)) for name in ("fact_dispatch", "dim_unit", "dim_region")]
    return zoneless(gold.star(*tables)).select(*MESSAGE, "trading_date", "unit_name", "region_name")


@query
def daily_run_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run log of a chain that is fed every raw message: keys repeat, so the first gate stops it."""
    root, chain = daily_chain(spark, sf_dir)
    send(dispatch(spark, sf_dir), f"{root}/topic")
    try:
        daily.run(spark, chain)
    except quality.QualityError:
        pass
    return spark.table(chain.table("run_log")).select("stage", "status")


# A quarter of an hour into an interval.
SECOND_RUN = "2024-01-15 12:15:00"


@query
def daily_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one chain, and every share that was published: the second run sends new and changed ones only."""
    root, chain = daily_chain(spark, sf_dir)
    late = F.col("ingested_at") >= F.lit(SECOND_RUN).cast("timestamp_ntz")
    rows = dispatch(spark, sf_dir)
    topic = None
    for part, chosen in enumerate((~late, late)):
        send(silver.dedupe(rows.where(chosen), KEY, ORDER), f"{root}/topic")
        target = {"fmt": "text", "path": f"{root}/shares-{part}"}
        daily.run(spark, replace(chain, target=target, run_id=f"run-{part}"))
        sent = parse_json(readers.messages(spark, "text", f"{root}/shares-{part}"), schemas.SHARE_MESSAGE)
        sent = sent.select(F.lit(part).alias("run"), "event_time", rounded("solar_share").alias("solar_share"))
        topic = sent if topic is None else topic.unionByName(sent)
    return topic


@query
def silver_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw message through the bronze stream into the silver rows: the last arrival of a key wins."""
    root, chain = daily_chain(spark, sf_dir)
    send(dispatch(spark, sf_dir), f"{root}/topic")
    daily.load_metadata(spark, chain)
    daily.load_bronze(spark, chain)
    daily.build_silver(spark, chain, daily.find_news(spark, chain))
    return zoneless(spark.table(chain.table("silver_dispatch_clean"))).select(*MESSAGE, "trading_date", "station_name")


# --- quality ----------------------------------------------------------------------------------------------------------


@query
def dq_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(dispatch(spark, sf_dir), quality.BRONZE_SUITE)


@query
def dq_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(silver_rows(spark, sf_dir), quality.SILVER_SUITE)


# Bounds that part of the given values miss, with and without tolerance.
NARROW_SUITE = {
    "expectation_suite_name": "narrow_suite",
    "expectations": [
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "generated_mw", "min_value": 0, "max_value": 100},
        },
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "generated_mw", "min_value": 1, "mostly": 0.95},
        },
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "fuel_type", "value_set": ["Coal", "Gas", "Hydro", "Wind"], "mostly": 0.75},
        },
        {
            "expectation_type": "expect_column_values_to_be_of_type",
            "kwargs": {"column": "unit_id", "type_": "DoubleType"},
        },
    ],
}


@query
def dq_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate(dispatch(spark, sf_dir), NARROW_SUITE)


@query
def dq_compound_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named checkpoint over the rows of a SQL text, its results appended to a table."""
    database = new_database(spark)
    bronze_rows = dispatch(spark, sf_dir).withColumn("trading_date", F.to_date("trading_interval"))
    sinks.replace_table(bronze_rows, f"{database}.bronze_dispatch", ["trading_date"])
    found = quality.run_checkpoint(
        spark,
        "bronze_checkpoint",
        f"SELECT * FROM {database}.bronze_dispatch",
        quality.BRONZE_SUITE,
        results_table=f"{database}.validations",
        run_id="run-1",
    )
    return found.select("checkpoint", "run_id", "name", "column", "element_count", "unexpected_count", "success")


@query
def dq_layer_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer job: the silver files are read, pass a suite from a YAML file, and go on."""
    import yaml

    folder = scratch_dir(spark, "layer")
    silver_rows(spark, sf_dir).write.parquet(f"{folder}/silver")
    # The suite's file is configuration on the driver.
    with tempfile.NamedTemporaryFile("w", suffix=".yml") as file:
        yaml.safe_dump(quality.SILVER_SUITE, file)
        file.flush()
        suite = quality.load_suite(file.name)
    return quality.run_job(spark, f"{folder}/silver", suite).select(*MESSAGE, "trading_date", "station_name")


@query
def dq_layer_job_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer job over raw rows, whose repeated keys stop it: the checks that failed, as its error tells them."""
    folder = scratch_dir(spark, "layer")
    dispatch(spark, sf_dir).write.parquet(f"{folder}/bronze")
    told = ""
    try:
        quality.run_job(spark, f"{folder}/bronze", quality.BRONZE_SUITE)
    except quality.QualityError as error:
        told = str(error).partition("failed: ")[2]
    return spark.createDataFrame([(part,) for part in told.split("; ")], "failed string")


@query
def dbt_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests of written tables: the fact and the dimensions, each as the raw layer and as the model above it."""
    database = new_database(spark)
    rows = {
        "fact_dispatch": gold.fact_rows(silver_rows(spark, sf_dir)),
        "dim_unit": gold.dim_unit_rows(units(spark, sf_dir)),
        "dim_region": gold.dim_region_rows(regions(spark, sf_dir)),
    }
    models = {}
    for name, df in rows.items():
        sinks.replace_table(df, f"{database}.{name}")
        models[f"raw_{name}"] = models[name] = spark.table(f"{database}.{name}")
    parts = [quality.model_tests(df, name, quality.MODEL_TESTS[name]) for name, df in models.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = T.StructType([f for f in schemas.BRONZE if f.name != "arrival"])
    contract = schemas.with_type(schemas.with_ntz(known), unit_id=T.LongType())
    return quality.schema_drift(dispatch(spark, sf_dir), contract)


# --- metrics ----------------------------------------------------------------------------------------------------------


@query
def generation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.generation_mix(deduped(spark, sf_dir))
    return found.select(
        "trading_interval", "source", rounded("mw", 4).alias("mw"), rounded("percent", 4).alias("percent")
    )


@query
def coal_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coal_percent_rows(spark, sf_dir).withColumn("percent", rounded("percent"))


RATE_WINDOW = "6 hours"


def power_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generation metric as a long table, one series per source."""
    raw = dispatch(spark, sf_dir)
    rows = metrics.to_metric(raw, "power_generation_megawatts", "ingested_at", "generated_mw", ["fuel_type"])
    return rows.withColumn("source", F.col("labels")["fuel_type"])


@query
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.rate(power_metric(spark, sf_dir), ["source"], "ts", "value", RATE_WINDOW)
    return found.withColumn("rate", rounded("rate", 8))


@query
def generation_mix_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate summed by source, at instants 30 minutes apart."""
    rows = power_metric(spark, sf_dir)
    instants = metrics.evaluation_times(rows, ["source"], "ts", "30 minutes")
    found = metrics.rate_by(rows, ["source"], ["source"], "ts", "value", RATE_WINDOW, instants)
    return found.withColumn("rate", rounded("rate", 8))


@query
def counter_rate_extrapolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate at instants 30 minutes apart, stretched to the edges of the window."""
    rows = power_metric(spark, sf_dir)
    instants = metrics.evaluation_times(rows, ["source"], "ts", "30 minutes")
    found = metrics.rate(rows, ["source"], "ts", "value", RATE_WINDOW, at=instants, extrapolate=True)
    # Single precision: many rates end in an exact half of a decimal digit, where the last bit decides a rounding.
    return found.withColumn("rate", F.col("rate").cast("float"))


@query
def coal_share_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the coal series in the sum of all rates, at instants 30 minutes apart."""
    by_source = generation_mix_rate(spark, sf_dir)
    return metrics.label_share(by_source, ["ts"], "source", "coal", "rate").withColumn("percent", rounded("percent", 4))


@query
def instant_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.instant(dispatch(spark, sf_dir), ["unit_id"], "ingested_at", "generated_mw", "sum", ["event_id"])
    return found.select(rounded("value", 4).alias("value"))


@query
def instant_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.instant(dispatch(spark, sf_dir), ["unit_id"], "ingested_at", "generated_mw", "avg", ["event_id"])
    return found.select(rounded("value", 4).alias("value"))


# --- alerts -----------------------------------------------------------------------------------------------------------

COAL_60 = alerts.Rule("HighCoalPercentage", "warning", threshold=60.0, for_duration="30 minutes")
# The given rates are spread over five sources, so a coal share above 60 % hardly occurs: the threshold is the data's, the
# duration the rule's.
COAL_RATE = 30.0
COAL_30 = alerts.Rule("HighCoalPercentage", "warning", threshold=30.0, min_count=3)


def _coal_alerts(spark: SparkSession, sf_dir: str, rule: alerts.Rule) -> DataFrame:
    rows = coal_percent_rows(spark, sf_dir)
    cut = bucket_width(dispatch(spark, sf_dir), [], "trading_interval", "1 day")
    return alerts.threshold_alert(rows, [], "trading_interval", "percent", rule, "30 minutes", cut)


@query
def coal_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coal_alerts(spark, sf_dir, COAL_60).withColumn("peak", rounded("peak", 4))


@query
def coal_alert_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coal_alerts(spark, sf_dir, COAL_30).withColumn("peak", rounded("peak", 4))


@query
def coal_alert_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both coded rules with their own numbers (60 % for five minutes, 70 % for three intervals), on doubled percentages:
    the given coal shares are about half of what the rules were made for."""
    rows = coal_percent_rows(spark, sf_dir).withColumn("percent", F.col("percent") * 2)
    cut = bucket_width(dispatch(spark, sf_dir), [], "trading_interval", "1 day")
    found = [
        alerts.threshold_alert(rows, [], "trading_interval", "percent", rule, "30 minutes", cut).withColumn(
            "threshold", F.lit(rule.threshold)
        )
        for rule in (alerts.HIGH_COAL, alerts.HIGH_COAL_INTERVALS)
    ]
    return found[0].unionByName(found[1]).withColumn("peak", rounded("peak", 4))


@query
def coal_rate_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coded rule on counter rates: the coal series' share of them all above ``COAL_RATE`` for five minutes."""
    rows = power_metric(spark, sf_dir)
    instants = metrics.evaluation_times(rows, ["source"], "ts", "30 minutes")
    rates = metrics.rate_by(rows, ["source"], ["source"], "ts", "value", RATE_WINDOW, instants)
    share = metrics.label_share(rates, ["ts"], "source", "coal", "rate").withColumn("percent", rounded("percent", 6))
    rule = replace(alerts.HIGH_COAL, threshold=COAL_RATE)
    # The raw rows tell how fine to cut; measuring the shares would compute the rates once more.
    cut = bucket_width(rows, [], "ts", "1 day")
    found = alerts.threshold_alert(share, [], "ts", "percent", rule, "30 minutes", cut)
    return found.withColumn("peak", rounded("peak", 4))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each unit's events as run states: an error event is a failed run. Runs are hours apart."""
    runs = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("job"),
        "ts",
        F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("status"),
    )
    return alerts.status_alert(runs, ["job"], "ts", "status", step="1 day")


@query
def run_failure_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir)


@query
def batch_duration_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unit's events of one day as a run from the first to the last of them."""
    runs = (
        dispatch(spark, sf_dir)
        .groupBy("unit_id", F.to_date("ingested_at").alias("run_date"))
        .agg(F.min("ingested_at").alias("started_at"), F.max("ingested_at").alias("finished_at"))
    )
    return alerts.slow_runs(runs, "started_at", "finished_at")


@query
def alert_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["alertname", "severity", "started_at", "resolved_at"]
    found = _coal_alerts(spark, sf_dir, COAL_30).select(*columns).unionByName(_failures(spark, sf_dir).select(*columns))
    return alerts.group_alerts(found)


# --- forecasts --------------------------------------------------------------------------------------------------------


@query
def history_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History of every event: number and sum of the values in its last 14 days."""
    found = forecast.history(table(spark, sf_dir, "events"), [], "ts", "value")
    return found.select("ts", "n", rounded("sum_y", 4).alias("sum_y"))


@query
def history_window_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forecast.history(table(spark, sf_dir, "events"), ["event_type"], "ts", "value")
    return found.select("event_type", "ts", "n", rounded("sum_y", 4).alias("sum_y"))


@query
def future_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    origins = shares(spark, sf_dir).select(F.col("event_time").alias("origin_time"))
    return forecast.future_frame(origins, "origin_time")


def _forecast(spark: SparkSession, sf_dir: str, model: str, origins: str) -> DataFrame:
    rows = shares(spark, sf_dir)
    return forecast.MODELS[model](rows, [], "event_time", "solar_share", origins=origins)


def _fuel_forecast(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """One series per fuel, forecast from its last interval."""
    mix = metrics.generation_mix(deduped(spark, sf_dir))
    return forecast.MODELS[model](mix, ["source"], "trading_interval", "percent")


@query
def forecast_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir, "linear", "all").withColumn("yhat", rounded("yhat"))


@query
def forecast_linear_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuel_forecast(spark, sf_dir, "linear").withColumn("yhat", rounded("yhat", 4))


@query
def forecast_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast(spark, sf_dir, "seasonal_mean", "all").withColumn("yhat", rounded("yhat"))


@query
def forecast_seasonal_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuel_forecast(spark, sf_dir, "seasonal_mean").withColumn("yhat", rounded("yhat", 4))


@query
def forecast_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two points far apart fit a trend whose last digits depend on the order of the sums.
    return _forecast(spark, sf_dir, "additive", "all").withColumn("yhat", rounded("yhat", 4))


@query
def forecast_additive_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fuel_forecast(spark, sf_dir, "additive").withColumn("yhat", rounded("yhat", 4))


@query
def forecast_mape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of the straight-line forecast one step ahead, against the share that came."""
    rows = shares(spark, sf_dir)
    made = forecast.linear(rows, [], "event_time", "solar_share", horizon=1, origins="all")
    found = forecast.score(made, rows, [], "event_time", "solar_share")
    return found.withColumn("mape", rounded("mape", 4))


@query
def forecast_drift_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources whose straight-line forecast, one step ahead, misses their percentage by too much on average."""
    mix = metrics.generation_mix(deduped(spark, sf_dir))
    made = forecast.linear(mix, ["source"], "trading_interval", "percent", horizon=1, origins="all")
    scores = forecast.score(made, mix, ["source"], "trading_interval", "percent")
    return alerts.drift_alert(scores).select(
        "alertname", "severity", "source", "pairs", rounded("mape", 4).alias("mape")
    )


# --- feeds ------------------------------------------------------------------------------------------------------------


@query
def changed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.changed_payloads(payloads(spark, sf_dir), [], "page_id", "content", width=100_000).select("page_id")


@query
def payload_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload bytes as text."""
    rows = payloads(spark, sf_dir).withColumn("content", F.col("content").cast("binary"))
    return feed.decode_payload(rows, "content").withColumn("digest", F.md5(F.col("content").cast("binary")))


@query
def model_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that is only a view, read by its name."""
    name = f"dispatch_{uuid.uuid4().hex[:12]}"
    sinks.replace_view(gold.generation_by_unit_fuel(dispatch(spark, sf_dir)), name)
    found = spark.sql(f"SELECT unit_id, fuel_type, max(generated_mw) AS peak FROM {name} GROUP BY unit_id, fuel_type")
    return found.withColumn("peak", rounded("peak", 4))


@query
def changed_payloads_by_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user as a feed whose payload is the event type: repeated types in a row are dropped."""
    rows = table(spark, sf_dir, "events")
    found = feed.changed_payloads(rows, ["user_id"], "ts", "event_type", width="1 day", ties=["event_id"])
    return found.select("event_id", "user_id", "event_type")


# --- streams ----------------------------------------------------------------------------------------------------------
# Each lands the whole input in three parts by time and runs the stream after every part, on one checkpoint.

PARTS = 3


def in_parts(
    rows: DataFrame, by: str, folder: str, run: Callable[[], object], fmt: str = "parquet", **options: object
) -> None:
    """Append ``rows`` to ``folder`` in ``PARTS`` stretches of ``by`` and call ``run`` after each."""
    low, high = rows.agg(F.min(by), F.max(by)).first()
    edges = [low + (high - low) * part / PARTS for part in range(1, PARTS)]
    for part in range(PARTS):
        chosen = rows
        if part:
            chosen = chosen.where(F.col(by) >= F.lit(edges[part - 1]).cast(rows.schema[by].dataType))
        if part < PARTS - 1:
            chosen = chosen.where(F.col(by) < F.lit(edges[part]).cast(rows.schema[by].dataType))
        written = chosen.select("value") if fmt == "text" else chosen
        written.write.mode("append").format(fmt).options(**options).save(folder)
        run()


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ, like the given tables."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    )


@query
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch rows as CSV messages through the bronze stream; wind messages lack their fuel and are quarantined."""
    root, database = scratch_dir(spark, "bronze"), new_database(spark)
    rows = dispatch(spark, sf_dir)
    line = F.when(F.col("fuel_type") == "Wind", F.to_csv(F.struct(*MESSAGE[:3]))).otherwise(F.to_csv(F.struct(*MESSAGE)))
    source, target, rejected = f"{root}/topic", f"{database}.bronze_dispatch", f"{database}.bronze_rejected"

    def run() -> None:
        lines = readers.message_stream(spark, "text", source)
        stream_bronze.run_bronze(spark, lines, target, f"{root}/checkpoint", rejected)

    in_parts(rows.withColumn("value", line), "ingested_at", source, run, "text")
    kept = spark.table(target).select(*MESSAGE, "trading_date", F.lit(False).alias("quarantined"))
    bad = spark.table(rejected).select(
        *MESSAGE, F.lit(None).cast("date").alias("trading_date"), F.lit(True).alias("quarantined")
    )
    return zoneless(kept.unionByName(bad))


@query
def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed file for each day, read in many blocks: the number of every line in its file."""
    root = scratch_dir(spark, "landed")
    rows = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), "event_id", F.concat_ws(",", "event_id", "event_type").alias("value")
    )
    ordered = rows.repartition("day").sortWithinPartitions("day", "event_id").drop("event_id")
    ordered.write.partitionBy("day").text(f"{root}/files")
    with settings(spark, files_maxPartitionBytes=str(16 << 10)):
        found = readers.messages(spark, "text", f"{root}/files")
        lines = found.select(
            F.split("value", ",")[0].cast("bigint").alias("event_id"), F.col("arrival.offset").alias("line")
        )
        lines.write.parquet(f"{root}/lines")
    return spark.read.schema(lines.schema).parquet(f"{root}/lines")


@query
def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table after its closed days were compacted, by a run that stopped half way and one that ended it."""
    root, database = scratch_dir(spark, "bronze"), new_database(spark)
    source, target = f"{root}/topic", f"{database}.bronze_dispatch"

    def run() -> None:
        lines = readers.message_stream(spark, "text", source)
        stream_bronze.run_bronze(spark, lines, target, f"{root}/checkpoint")

    rows = dispatch(spark, sf_dir).withColumn("value", F.to_csv(F.struct(*MESSAGE)))
    for part in range(PARTS):
        rows.where(F.col("event_id") % PARTS == part).select("value").write.mode("append").text(source)
        run()
    stopped = compaction.steps(spark, target, "trading_date", "2024-01-20")
    for step in stopped:
        if step == "added":
            break
    stopped.close()
    stream_bronze.compact(spark, target, "2024-01-20")
    return zoneless(spark.table(target).select(*MESSAGE, "trading_date"))


@query
def late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come ten days after their time, of which those behind the newest by over five days are kept apart."""
    root = scratch_dir(spark, "late")
    rows = dispatch(spark, sf_dir).select("event_id", "unit_id", "ingested_at")
    stretch = F.least(F.lit(2), F.floor(F.datediff("ingested_at", F.lit("2024-01-01").cast("date")) / 10))
    arrival = stretch + (F.col("event_id") % 7 == 0).cast("int")
    for part in range(4):
        rows.where(arrival == part).write.mode("append").parquet(f"{root}/topic")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        writers = [sinks.batch_folder(f"{root}/{name}") for name in ("on-time", "late")]
        late.split_late(stream, "ingested_at", "5 days", *writers, f"{root}/marks", f"{root}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{root}/late").select(*rows.columns)


@query
def topic_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares sent twice each, as by a stream that fails after sending, and read once."""
    root = scratch_dir(spark, "outbox")
    rows = shares(spark, sf_dir)

    def encode(batch: DataFrame) -> DataFrame:
        return sinks.encode_json(batch.withColumn("event_time", F.col("event_time").cast("string")), rows.columns).select(
            "value",
            F.lit("shares").alias("topic"),
            F.lit(0).alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )

    send = sinks.outbox(f"{root}/outbox", encode, "parquet", f"{root}/sent")

    def twice(batch: DataFrame, batch_id: int) -> None:
        send(batch, batch_id)
        send(batch, batch_id)

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        sinks.fan_out(stream, {"topic": twice}, f"{root}/checkpoint")

    in_parts(rows, "event_time", f"{root}/topic", run)
    received = readers.once(readers.messages(spark, "parquet", f"{root}/sent"))
    found = parse_json(received, schemas.SHARE_MESSAGE)
    return found.select("event_time", rounded("solar_share").alias("solar_share"))


@query
def feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed CSV documents to a topic, one line per record, as they arrive; the topic's records."""
    root = scratch_dir(spark, "producer")
    rows = dispatch(spark, sf_dir)

    topic = stream_feed.topic_writer(lambda rows: sinks.encode_csv(rows, MESSAGE, key="unit_id"), "text", f"{root}/topic")

    def run() -> None:
        stream_feed.run_feed(spark, f"{root}/landing", NTZ_MESSAGE, topic, f"{root}/checkpoint")

    for part, header in enumerate(HEADERS):
        half = rows.where(F.col("event_id") % len(HEADERS) == part)
        in_parts(half.select(*header), "trading_interval", f"{root}/landing", run, "csv", header=True)
    good, _ = bronze.parse_dispatch(readers.messages(spark, "text", f"{root}/topic"), NTZ_MESSAGE)
    return good.select(*MESSAGE)


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first arrival of every interval and unit."""
    root, target = scratch_dir(spark, "dedupe"), f"{new_database(spark)}.dispatch"
    rows = dispatch(spark, sf_dir).withColumn("trading_date", F.to_date("trading_interval"))

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        stream_tables.first_arrivals_stream(stream, target, KEY, ORDER, f"{root}/checkpoint", ["trading_date"])

    in_parts(rows, "ingested_at", f"{root}/topic", run)
    return spark.table(target).select(*MESSAGE, "trading_date", *ORDER)


@query
def stream_dedupe_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a de-duplication whose state expires; which row of a batch stays is not fixed, so keys are compared."""
    root = scratch_dir(spark, "dedupe")
    rows = dispatch(spark, sf_dir)

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        unique = stream_tables.dedupe_stream(stream, KEY, "trading_interval")
        start(unique.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint")

    in_parts(rows, "ingested_at", f"{root}/topic", run)
    return zoneless(spark.read.parquet(f"{root}/out").select(*KEY))


@query
def changed_payloads_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "feed")
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        stream_feed.changed_payloads_stream(
            stream,
            ["user_id"],
            "ts",
            "event_type",
            "1 day",
            output=f"{root}/out",
            state=f"{root}/state",
            checkpoint=f"{root}/checkpoint",
            ties=["event_id"],
        )

    in_parts(rows, "ts", f"{root}/topic", run)
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "event_type")


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections by arrival: the last reading of an interval and unit stays."""
    root, database = scratch_dir(spark, "upsert"), new_database(spark)
    rows = dispatch(spark, sf_dir).withColumn("trading_date", F.to_date("trading_interval"))

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        stream_tables.upsert_stream(
            stream, f"{database}.dispatch", KEY, ORDER, f"{root}/checkpoint", partition_by=["trading_date"]
        )

    in_parts(rows, "ingested_at", f"{root}/topic", run)
    return spark.table(f"{database}.dispatch").select(*MESSAGE)


@query
def forecast_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares as JSON messages through the forecast stream, into a topic and a table; the table's rows."""
    root, target = scratch_dir(spark, "forecast"), f"{new_database(spark)}.forecasts"
    found = shares(spark, sf_dir).withColumn("at", F.col("event_time")).withColumn(
        "event_time", F.col("event_time").cast("string")
    )
    rows = found.select("at", F.to_json(F.struct("event_time", "solar_share")).alias("value"))

    def run() -> None:
        lines = readers.message_stream(spark, "text", f"{root}/topic")
        received = parse_shares(lines, schemas.SHARE_MESSAGE, "event_time", "solar_share")
        writers = {
            "topic": stream_forecasts.topic_writer("text", f"{root}/forecasts"),
            "table": stream_forecasts.table_writer(target),
        }
        stream_forecasts.run_forecast(received, writers, f"{root}/checkpoint", model="linear", emit="every")

    in_parts(rows, "at", f"{root}/topic", run, "text")
    written = zoneless(spark.table(target))
    return written.select(
        "origin_time", "n", "step", "event_time", rounded("forecast_solar_share").alias("forecast_solar_share")
    )


@query
def stream_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "alert")
    rows = dispatch(spark, sf_dir)

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        # There is one set of labels.
        stream_alerts.run_alerts(
            spark, stream, COAL_30, "30 minutes", root, "ingested_at", "fuel_type", "coal", "generated_mw", partitions=1
        )

    # Rows after all others, of no fuel, move the watermark past the last interval.
    last = rows.agg(F.max("ingested_at")).first()[0]
    ends = spark.createDataFrame([(last + timedelta(hours=h),) for h in (3, 6)], "ingested_at timestamp_ntz")
    in_parts(rows.unionByName(ends, allowMissingColumns=True), "ingested_at", f"{root}/topic", run)
    return zoneless(spark.read.parquet(f"{root}/changes"))


@query
def stream_rate_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate alert of :func:`coal_rate_alert`, evaluated as the samples come: rates, then shares and alerts."""
    root = scratch_dir(spark, "rates")
    rows = power_metric(spark, sf_dir).select("source", "ts", "value")
    rule = replace(alerts.HIGH_COAL, threshold=COAL_RATE)

    def run() -> None:
        samples = spark.readStream.schema(rows.schema).parquet(f"{root}/topic")
        found = stream_rates.rate_stream(samples, ["source"], "ts", "value", RATE_WINDOW, "30 minutes")
        # There are five series.
        with settings(spark, shuffle_partitions="5"):
            sinks.fan_out(found, {"rates": sinks.batch_folder(f"{root}/rates")}, f"{root}/rates-checkpoint")

    # Rows without a value, after all others, move the watermarks on.
    last = rows.agg(F.max("ts")).first()[0]
    later = [last + timedelta(hours=h) for h in (3, 6)]
    ends = spark.createDataFrame([(later[0],)], "ts timestamp_ntz")
    in_parts(rows.unionByName(ends, allowMissingColumns=True), "ts", f"{root}/topic", run)
    rated = "source string, ts timestamp, rate double"
    end = spark.createDataFrame([(None, t, None) for t in later], rated).coalesce(1)
    end.write.parquet(f"{root}/rates/batch_id=end")
    rates = spark.readStream.schema(rated).option("recursiveFileLookup", True).parquet(f"{root}/rates")
    _, log = stream_alerts.run_alerts(
        spark, rates, rule, "30 minutes", root, "ts", "source", "coal", "rate", partitions=1
    )
    changes = zoneless(spark.read.parquet(log)).where("state = 'resolved'")
    return changes.select("alertname", "severity", "started_at", "n", F.col("at").alias("resolved_at"))


@query
def stream_forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of one-step forecasts, joined to the shares as these come; their mean over all that came."""
    root = scratch_dir(spark, "errors")
    rows = shares(spark, sf_dir)
    made = forecast.linear(rows, [], "event_time", "solar_share", horizon=1, origins="all")

    def run() -> None:
        forecasts = spark.readStream.schema(made.schema).parquet(f"{root}/made")
        came = spark.readStream.schema(rows.schema).parquet(f"{root}/shares")
        found = stream_forecasts.error_stream(forecasts, came, [], "event_time", "solar_share")
        start(found.writeStream.format("parquet").option("path", f"{root}/out"), f"{root}/checkpoint")

    in_parts(made, "event_time", f"{root}/made", lambda: None)
    in_parts(rows, "event_time", f"{root}/shares", run)
    error = (F.avg("error") * 100).alias("mape")
    scored = spark.read.parquet(f"{root}/out").agg(F.count("error").alias("pairs"), error)
    return scored.withColumn("drifted", F.col("mape") > 20).withColumn("mape", rounded("mape", 4))
