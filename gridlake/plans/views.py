"""The given tables seen as dispatch, unit, region and payload data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.timeaxis import interval_start

# Fuel of each event type.
FUEL_OF_EVENT = {"view": "Coal", "click": "Gas", "purchase": "Solar", "signup": "Wind", "error": "Hydro"}
INTERVAL = "30 minutes"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dispatch(spark: SparkSession, sf_dir: str, interval: str = INTERVAL) -> DataFrame:
    """Events as dispatch rows: the user is the unit, the value its output, arrival decides between corrections."""
    pairs = [F.lit(part) for pair in FUEL_OF_EVENT.items() for part in pair]
    return table(spark, sf_dir, "events").select(
        interval_start("ts", interval).alias("trading_interval"),
        F.col("user_id").cast("string").alias("unit_id"),
        F.col("value").alias("generated_mw"),
        F.create_map(*pairs)[F.col("event_type")].alias("fuel_type"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as units; a unit's region is its nation and its snapshot date one of 30 days."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("unit_id"),
        F.col("c_mktsegment").alias("fuel_type"),
        F.col("c_name").alias("station_name"),
        F.col("c_nationkey").cast("string").alias("region_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 30).cast("int")).alias("trading_date"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations, named with their region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("region_id"),
        F.concat_ws(" / ", "r_name", "n_name").alias("region_name"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("n_nationkey").cast("int")).alias("trading_date"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as payloads of one feed, in order of their id."""
    return table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
