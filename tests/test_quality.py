from __future__ import annotations

import pytest
from pyspark.sql import types as T

from gridlake.operators import quality
from tests.conftest import plan, rows


def suite(*items):
    return {
        "expectation_suite_name": "s",
        "expectations": [{"expectation_type": f"expect_{kind}", "kwargs": args} for kind, args in items],
    }


@pytest.fixture
def df(spark):
    data = [("a", 1.0), ("a", 5.0), ("b", None), (None, 11.0), (None, 12.0)]
    return spark.createDataFrame(data, "k string, v double")


@pytest.mark.parametrize(
    ("kind", "args", "expected"),
    [
        ("column_values_to_not_be_null", {"column": "k"}, (5, 2, False)),
        ("column_values_to_not_be_null", {"column": "k", "mostly": 0.6}, (5, 2, True)),
        ("column_values_to_not_be_null", {"column": "k", "mostly": 0.7}, (5, 2, False)),
        ("column_values_to_be_between", {"column": "v", "min_value": 1, "max_value": 11}, (4, 1, False)),
        ("column_values_to_be_between", {"column": "v", "min_value": 1}, (4, 0, True)),
        ("column_values_to_be_in_set", {"column": "k", "value_set": ["a"]}, (3, 1, False)),
        ("column_values_to_be_of_type", {"column": "v", "type_": "DOUBLE"}, (5, 0, True)),
        ("column_values_to_be_of_type", {"column": "v", "type_": "DoubleType"}, (5, 0, True)),
        ("column_values_to_be_of_type", {"column": "v", "type_": "INT"}, (5, 5, False)),
        ("column_values_to_be_unique", {"column": "k"}, (3, 2, False)),
        ("compound_columns_to_be_unique", {"column_list": ["k", "v"]}, (2, 0, True)),
    ],
)
def test_expectations(df, kind, args, expected):
    row = quality.validate(df, suite((kind, args))).first()
    assert (row.element_count, row.unexpected_count, row.success) == expected


def test_an_empty_table_passes(spark):
    empty = spark.createDataFrame([], "trading_interval timestamp, unit_id string, generated_mw double, fuel_type string")
    assert all(r.success for r in quality.validate(empty, quality.BRONZE_SUITE).collect())


def test_value_checks_share_one_pass(spark, df):
    checks = [("column_values_to_not_be_null", {"column": c}) for c in ("k", "v")] * 3
    text = plan(quality.validate(df, suite(*checks)))
    assert text.count("Scan ExistingRDD") == 1


def test_enforce(df):
    bad = suite(
        ("column_values_to_not_be_null", {"column": "k"}),
        ("column_values_to_be_of_type", {"column": "v", "type_": "double"}),
    )
    with pytest.raises(quality.QualityError, match="column_values_to_not_be_null.k.: 2/5"):
        quality.enforce(df, bad)
    assert quality.enforce(df, bad, min_success_ratio=0.5) is df


def test_suite_file_and_layer_job(spark, df, tmp_path):
    path = tmp_path / "suite.yml"
    path.write_text(
        "expectation_suite_name: from_file\n"
        "expectations:\n"
        "  - expectation_type: expect_column_values_to_not_be_null\n"
        "    kwargs:\n      column: k\n      mostly: 0.5\n"
    )
    loaded = quality.load_suite(str(path))
    df.write.parquet(str(tmp_path / "layer"))
    assert quality.run_job(spark, str(tmp_path / "layer"), loaded).count() == 5
    with pytest.raises(quality.QualityError, match="from_file"):
        loaded["expectations"][0]["kwargs"]["mostly"] = 1.0
        quality.run_job(spark, str(tmp_path / "layer"), loaded)


def test_checkpoints_append_their_results(spark, df, database):
    df.createOrReplaceTempView("checked")
    checks = suite(("column_values_to_not_be_null", {"column": "v"}))
    for run in ("r1", "r2"):
        found = quality.run_checkpoint(
            spark, "c", "SELECT * FROM checked WHERE k IS NOT NULL", checks, f"{database}.results", run
        )
        assert [(r.run_id, r.element_count, r.unexpected_count) for r in found.collect()] == [(run, 3, 1)]
    assert spark.table(f"{database}.results").count() == 2


def test_model_tests(df):
    tests = [
        {"column": "k", "test": "not_null"},
        {"column": "k", "test": "unique"},
        {"column": "v", "test": "accepted_range", "min_value": 2, "max_value": 11},
    ]
    assert rows(quality.model_tests(df, "m", tests)) == [
        ("m", "k", "not_null", 2, False),
        ("m", "k", "unique", 1, False),
        ("m", "v", "accepted_range", 2, False),
    ]


def test_schema_drift(df):
    contract = T.StructType(
        [T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("w", T.DateType())]
    )
    assert rows(quality.schema_drift(df, contract)) == [
        ("v", "type", "int", "double", 4),
        ("w", "missing", "date", None, 5),
    ]
    assert quality.schema_drift(df, df.schema).count() == 0
    assert rows(quality.schema_drift(df, T.StructType(df.schema.fields[1:]))) == [("k", "extra", None, "string", 3)]
