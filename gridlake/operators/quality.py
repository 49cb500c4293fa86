"""Declarative quality checks, compiled into as few passes over the table as possible."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two layer suites. Value checks ignore NULLs and bounds are inclusive.
FUELS = ["Coal", "Gas", "Hydro", "Wind", "Solar"]

BRONZE_SUITE: dict[str, Any] = {
    "expectation_suite_name": "bronze_suite",
    "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "trading_interval"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "unit_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "generated_mw"}},
        {
            "expectation_type": "expect_column_values_to_be_of_type",
            "kwargs": {"column": "generated_mw", "type_": "DOUBLE"},
        },
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "generated_mw", "min_value": 0, "max_value": 10000},
        },
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "fuel_type"}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "fuel_type", "value_set": FUELS},
        },
        {
            "expectation_type": "expect_compound_columns_to_be_unique",
            "kwargs": {"column_list": ["trading_interval", "unit_id"]},
        },
    ],
}

SILVER_SUITE: dict[str, Any] = {
    "expectation_suite_name": "silver_suite",
    "expectations": [
        {
            "expectation_type": "expect_column_values_to_not_be_null",
            "kwargs": {"column": "trading_interval", "mostly": 0.99},
        },
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "unit_id", "mostly": 0.99}},
        {
            "expectation_type": "expect_column_values_to_not_be_null",
            "kwargs": {"column": "generated_mw", "mostly": 0.98},
        },
        {
            "expectation_type": "expect_column_values_to_be_of_type",
            "kwargs": {"column": "generated_mw", "type_": "DOUBLE"},
        },
        {
            "expectation_type": "expect_column_values_to_be_between",
            "kwargs": {"column": "generated_mw", "min_value": 0, "max_value": 10000},
        },
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "fuel_type", "mostly": 0.95}},
        {
            "expectation_type": "expect_column_values_to_be_in_set",
            "kwargs": {"column": "fuel_type", "value_set": FUELS},
        },
        {
            "expectation_type": "expect_compound_columns_to_be_unique",
            "kwargs": {"column_list": ["trading_interval", "unit_id"]},
        },
    ],
}

RESULT = "name string, column string, element_count bigint, unexpected_count bigint, success boolean"


class QualityError(ValueError):
    """A suite failed."""


def load_suite(path: str) -> dict[str, Any]:
    """A suite from a YAML file (configuration, read on the driver)."""
    import yaml

    with open(path, encoding="utf-8") as handle:
        return yaml.safe_load(handle)


@dataclass(frozen=True)
class _Check:
    """One expectation: aggregates that run in the shared pass, or the key of a uniqueness pass."""

    order: int
    name: str
    column: str
    mostly: float
    total: Column | None = None
    bad: Column | None = None
    unique_on: tuple[str, ...] = ()


def _type_matches(actual: T.DataType, wanted: str) -> bool:
    name = wanted.lower()
    return name in (actual.simpleString().lower(), actual.typeName().lower(), type(actual).__name__.lower())


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _compile(df: DataFrame, suite: Mapping[str, Any]) -> list[_Check]:
    checks = []
    for order, item in enumerate(suite["expectations"]):
        kind, args = item["expectation_type"], item["kwargs"]
        name = kind.removeprefix("expect_")
        mostly = float(args.get("mostly", 1.0))
        if kind in ("expect_compound_columns_to_be_unique", "expect_column_values_to_be_unique"):
            keys = tuple(args["column_list"]) if "column_list" in args else (args["column"],)
            checks.append(_Check(order, name, ",".join(keys), mostly, unique_on=keys))
            continue
        column = args["column"]
        value = F.col(column)
        if kind == "expect_column_values_to_not_be_null":
            total, bad = F.count(F.lit(1)), _count(value.isNull())
        elif kind == "expect_column_values_to_be_between":
            low, high = args.get("min_value"), args.get("max_value")
            outside = F.lit(False)
            if low is not None:
                outside = outside | (value < low)
            if high is not None:
                outside = outside | (value > high)
            total, bad = F.count(value), _count(outside)
        elif kind == "expect_column_values_to_be_in_set":
            total, bad = F.count(value), _count(~value.isin(list(args["value_set"])))
        elif kind == "expect_column_values_to_be_of_type":
            matches = _type_matches(df.schema[column].dataType, args["type_"])
            total = F.count(F.lit(1))
            bad = F.lit(0).cast("bigint") if matches else F.count(F.lit(1))
        else:
            raise ValueError(f"unknown expectation {kind!r}")
        checks.append(_Check(order, name, column, mostly, total, bad))
    return checks


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(total, bad)``: rows with a complete key, and rows of keys that occur more than once.

    The count per key is combined before the exchange, so a key with very many copies costs one row per map task.
    """
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    return (
        df.where(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("bad"),
        )
    )


def validate(df: DataFrame, suite: Mapping[str, Any]) -> DataFrame:
    """One row per expectation. All value checks share one pass; each uniqueness key adds one aggregate."""
    checks = _compile(df, suite)
    parts = []
    shared = [c for c in checks if not c.unique_on]
    if shared:
        counts = [c.total.alias(f"__t{c.order}") for c in shared] + [c.bad.alias(f"__b{c.order}") for c in shared]
        rows = F.explode(F.array(*[_row(c, F.col(f"__t{c.order}"), F.col(f"__b{c.order}")) for c in shared]))
        parts.append(df.agg(*counts).select(rows.alias("r")))
    for check in checks:
        if check.unique_on:
            counted = duplicate_counts(df, check.unique_on)
            parts.append(counted.select(_row(check, F.col("total"), F.col("bad")).alias("r")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result.select("r.*")


def _row(check: _Check, total: Column, bad: Column) -> Column:
    within = F.coalesce(F.try_divide(bad.cast("double"), total.cast("double")), F.lit(0.0)) <= F.lit(1 - check.mostly + 1e-12)
    return F.struct(
        F.lit(check.name).alias("name"),
        F.lit(check.column).alias("column"),
        total.cast("bigint").alias("element_count"),
        bad.cast("bigint").alias("unexpected_count"),
        within.alias("success"),
    )


def enforce(df: DataFrame, suite: Mapping[str, Any], min_success_ratio: float = 1.0) -> DataFrame:
    """``df`` itself when enough expectations hold, else :class:`QualityError`. Collects one row per expectation."""
    check_results(validate(df, suite).collect(), suite.get("expectation_suite_name", "suite"), min_success_ratio)
    return df


def check_results(rows: Sequence[Any], name: str, min_success_ratio: float = 1.0) -> None:
    failed = [r for r in rows if not r["success"]]
    if rows and (len(rows) - len(failed)) / len(rows) < min_success_ratio:
        what = "; ".join(f"{r['name']}({r['column']}): {r['unexpected_count']}/{r['element_count']}" for r in failed)
        raise QualityError(f"{name} validation failed: {what}")


def run_checkpoint(
    spark: SparkSession,
    name: str,
    query: str | DataFrame,
    suite: Mapping[str, Any],
    results_table: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Validate the rows of a SQL text or a table; with ``results_table`` the result rows are also appended there.

    Every call is an ``attempt`` of its own, and only its rows are returned, however often a run id comes again.
    """
    rows = spark.sql(query) if isinstance(query, str) else query
    result = validate(rows, suite).select(
        F.lit(name).alias("checkpoint"), F.lit(suite["expectation_suite_name"]).alias("suite"), "*"
    )
    if results_table is None:
        return result
    attempt = uuid.uuid4().hex
    stamped = result.withColumns(
        {"run_id": F.lit(run_id or ""), "run_at": F.current_timestamp(), "attempt": F.lit(attempt)}
    )
    stamped.write.mode("append").saveAsTable(results_table)
    return spark.table(results_table).where(F.col("attempt") == attempt)


def run_job(
    spark: SparkSession, path: str, suite: Mapping[str, Any], min_success_ratio: float = 1.0
) -> DataFrame:
    """Load a layer's files and stop when its suite fails."""
    return enforce(spark.read.parquet(path), suite, min_success_ratio)


# The column tests of the gold models.
MODEL_TESTS: dict[str, list[dict[str, Any]]] = {
    "raw_fact_dispatch": [
        {"column": "trading_interval", "test": "not_null"},
        {"column": "unit_id", "test": "not_null"},
        {"column": "unit_id", "test": "unique"},
    ],
    "raw_dim_unit": [{"column": "unit_id", "test": "not_null"}, {"column": "unit_id", "test": "unique"}],
    "raw_dim_region": [{"column": "region_id", "test": "not_null"}, {"column": "region_id", "test": "unique"}],
    "fact_dispatch": [
        {"column": "trading_date", "test": "not_null"},
        {"column": "generated_mw", "test": "not_null"},
        {"column": "generated_mw", "test": "accepted_range", "min_value": 0},
    ],
    "dim_unit": [{"column": "unit_id", "test": "not_null"}, {"column": "unit_id", "test": "unique"}],
    "dim_region": [{"column": "region_id", "test": "not_null"}, {"column": "region_id", "test": "unique"}],
}


def model_tests(df: DataFrame, model: str, tests: Sequence[Mapping[str, Any]]) -> DataFrame:
    """``(model, column, test, failures, passed)``. A unique test fails once per value that occurs more than once."""
    value_tests = [t for t in tests if t["test"] != "unique"]
    parts = []
    if value_tests:
        counts = []
        for number, test in enumerate(value_tests):
            value = F.col(test["column"])
            if test["test"] == "not_null":
                failing = value.isNull()
            elif test["test"] == "accepted_range":
                failing = F.lit(False)
                if "min_value" in test:
                    failing = failing | (value < test["min_value"])
                if "max_value" in test:
                    failing = failing | (value > test["max_value"])
            else:
                raise ValueError(f"unknown test {test['test']!r}")
            counts.append(_count(failing).alias(f"__f{number}"))
        rows = [_test_row(model, t, F.col(f"__f{i}")) for i, t in enumerate(value_tests)]
        parts.append(df.agg(*counts).select(F.explode(F.array(*rows)).alias("r")))
    for test in tests:
        if test["test"] == "unique":
            column = test["column"]
            repeated = (
                df.where(F.col(column).isNotNull())
                .groupBy(column)
                .agg(F.count(F.lit(1)).alias("__n"))
                .agg(_count(F.col("__n") > 1).alias("__f"))
            )
            parts.append(repeated.select(_test_row(model, test, F.col("__f")).alias("r")))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result.select("r.*")


def _test_row(model: str, test: Mapping[str, Any], failures: Column) -> Column:
    return F.struct(
        F.lit(model).alias("model"),
        F.lit(test["column"]).alias("column"),
        F.lit(test["test"]).alias("test"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    )


def schema_drift(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``(column, kind, expected, actual, affected_rows)``, one row per difference between the data and its contract.

    ``affected_rows`` counts, in one pass, the rows that hold a value in an extra or retyped column, and all rows for a
    missing one.
    """
    expected = {f.name: f.dataType.simpleString() for f in contract}
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    found = []
    for name in [*expected, *[n for n in actual if n not in expected]]:
        if name not in actual:
            found.append((name, "missing", expected[name], None, F.count(F.lit(1))))
        elif name not in expected:
            found.append((name, "extra", None, actual[name], F.count(name)))
        elif expected[name] != actual[name]:
            found.append((name, "type", expected[name], actual[name], F.count(name)))
    schema = "column string, kind string, expected string, actual string, affected_rows bigint"
    if not found:
        return df.sparkSession.createDataFrame([], schema)
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("kind"),
            F.lit(want).cast("string").alias("expected"),
            F.lit(have).cast("string").alias("actual"),
            F.col(f"__r{i}").alias("affected_rows"),
        )
        for i, (name, kind, want, have, _) in enumerate(found)
    ]
    counts = df.agg(*[count.alias(f"__r{i}") for i, (*_, count) in enumerate(found)])
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
