from __future__ import annotations

import csv
import io

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import bronze, lookup, silver
from gridlake.plans.registered import REGISTRY
from gridlake.sources import readers, sinks
from tests.conftest import SMALL, plan, rows

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 5)
DISPATCH = "unit_id string, trading_interval timestamp, generated_mw double, fuel_type string, trading_date date"


@pytest.fixture
def dispatch(spark):
    return spark.createDataFrame(
        [
            ("UNIT1", T0, 100.0, "Coal", T0.date()),
            ("UNIT1", T0, 100.0, "Coal", T0.date()),
            ("UNIT2", T1, 50.0, "Solar", T1.date()),
        ],
        DISPATCH,
    )


@pytest.fixture
def metadata(spark):
    return spark.createDataFrame(
        [("UNIT1", "Coal", "StationA"), ("UNIT2", "Solar", "StationB")], schemas.UNIT_METADATA
    )


def test_clean_dispatch(dispatch, metadata):
    for keep, order in (("latest", ["generated_mw"]), ("any", [])):
        found = silver.clean_dispatch(dispatch, metadata, order, keep)
        assert found.count() == 2
        assert {(r.unit_id, r.fuel_type, r.station_name) for r in found.collect()} == {
            ("UNIT1", "Coal", "StationA"),
            ("UNIT2", "Solar", "StationB"),
        }
        assert found.select("trading_interval", "unit_id").distinct().count() == 2


def test_metadata_files(spark, tmp_path, database):
    units, regions = tmp_path / "units.csv", tmp_path / "regions.csv"
    units.write_text("unit_id,fuel_type,station_name\nUNIT1,Coal,StationA\nUNIT2,Solar,StationB\n")
    regions.write_text("region_id,region_name\nNSW1,New South Wales\nQLD1,Queensland\n")
    sinks.replace_table(readers.read_metadata(spark, str(units), schemas.UNIT_METADATA), f"{database}.units")
    sinks.replace_table(readers.read_metadata(spark, str(regions), schemas.REGION_METADATA), f"{database}.regions")
    assert rows(spark.table(f"{database}.units").select("unit_id", "station_name")) == [
        ("UNIT1", "StationA"),
        ("UNIT2", "StationB"),
    ]
    assert ("NSW1", "New South Wales") in rows(spark.table(f"{database}.regions"))
    wrong = readers.read_metadata(spark, str(units), schemas.REGION_METADATA)
    with pytest.raises(Exception, match="(?i)header|schema"):
        wrong.collect()


def test_latest_correction_wins_and_null_keys_are_one_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 3, 3.0), ("a", 2, 2.0), (None, 1, 7.0), (None, 2, 8.0)], "k string, at int, v double"
    )
    assert rows(silver.dedupe(df, ["k"], ["at"])) == [("a", 3, 3.0), (None, 2, 8.0)]
    assert rows(silver.dedupe(df, ["k"], ["at"], "first")) == [("a", 1, 1.0), (None, 1, 7.0)]
    once = silver.dedupe(df, ["k"], ["at"])
    assert rows(silver.dedupe(once, ["k"], ["at"])) == rows(once)
    with pytest.raises(ValueError, match="order_by"):
        silver.dedupe(df, ["k"])


def test_dedupe_reduces_copies_before_the_exchange(spark):
    df = spark.read.parquet(f"{SMALL}/events.parquet")
    text = plan(silver.dedupe(df, ["user_id"], ["ts"]))
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]


def test_enrich_keeps_the_number_of_rows(spark, dispatch):
    dim = spark.createDataFrame([("UNIT1", "A"), ("UNIT1", "B"), (None, "N")], "unit_id string, station_name string")
    extra = dispatch.unionByName(dispatch.limit(1).withColumn("unit_id", F.lit(None).cast("string")))
    found = silver.enrich(extra, dim, "unit_id", ["station_name"])
    assert found.count() == 4
    assert {(r.unit_id, r.station_name) for r in found.collect()} == {("UNIT1", "A"), ("UNIT2", None), (None, None)}
    latest = silver.enrich(extra, dim, "unit_id", ["station_name"], dim_order=["station_name"])
    assert {(r.unit_id, r.station_name) for r in latest.collect()} == {("UNIT1", "B"), ("UNIT2", None), (None, None)}


def test_small_lookup_is_broadcast(spark, dispatch, metadata):
    assert "BroadcastHashJoin" in plan(silver.enrich(dispatch, metadata, "unit_id", ["station_name"]))


def test_size_of_a_lookup(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x" * 1000, [1, 2], 1)] * 3, "k string, text string, list array<int>, n int")
    assert lookup.is_small(df) and lookup.is_small(df.limit(0))
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 3000)
    assert not lookup.is_small(df) and lookup.is_small(df.drop("text"))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    assert not lookup.is_small(df.drop("text"))


def test_a_large_lookup_is_shuffled_and_hot_keys_are_salted(spark, monkeypatch):
    fact = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("7"))
        .when(F.col("id") % 5 == 0, F.lit(None))
        .when(F.col("id") % 7 == 0, F.lit("unknown"))
        .otherwise((F.col("id") % 2000).cast("string"))
        .alias("unit_id"),
        "id",
    )
    dim = spark.range(1500).select(
        F.col("id").cast("string").alias("unit_id"), F.concat(F.lit("s"), "id").alias("station_name")
    )
    small = silver.enrich(fact, dim, "unit_id", ["station_name"])
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = silver.enrich(fact, dim, "unit_id", ["station_name"])
        assert "SortMergeJoin" in plan(large)
        assert rows(large) == rows(small) and large.count() == 30_000
        # The rows are read to count their keys and to be joined, and no third time.
        assert plan(large).split("== Initial Plan ==")[0].count("Range (0, 30000") <= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows(lookup.hot_keys(fact.where("unit_id IS NOT NULL"), ["unit_id"])) == [("7",), ("unknown",)]


def test_share_of_intervals_without_solar_or_without_generation(spark):
    df = spark.createDataFrame(
        [(1, "Solar", 1.0), (1, "Coal", 3.0), (2, "Coal", 5.0), (3, "Solar", 0.0)],
        "trading_interval int, fuel_type string, generated_mw double",
    )
    assert rows(silver.fuel_share(df)) == [(1, 0.25), (2, None), (3, None)]
    assert rows(silver.fuel_share(df, fill_zero=True)) == [(1, 0.25), (2, 0.0), (3, None)]


def test_shares_of_all_fuels_add_up(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("day", F.to_date("ts"))
    kinds = [r[0] for r in events.select("event_type").distinct().collect()]
    total = 0.0
    for kind in kinds:
        part = silver.fuel_share(events, "day", "value", "event_type", kind, "share", fill_zero=True)
        total += part.where("event_time = DATE'2024-01-05'").first()["share"]
    assert total == pytest.approx(1.0)


LINES = [
    # line, trading_interval, unit_id, generated_mw, fuel_type, corrupt
    ("2024-01-01 00:00:00,U1,10.5,Coal", T0, "U1", 10.5, "Coal", False),
    ("bad,U1,1,Coal", None, "U1", 1.0, "Coal", True),
    ("2024-01-01 00:00:00,U1,xx,Coal", T0, "U1", None, "Coal", True),
    ("2024-01-01 00:00:00,U1", T0, "U1", None, None, True),
    ("2024-01-01 00:00:00,U1,1,Coal,extra", T0, "U1", 1.0, "Coal", True),
    ("", None, None, None, None, True),
    ("2024/01/01 00:05:00,U1,1,Coal", None, "U1", 1.0, "Coal", True),
    ('2024-01-01 00:00:00,"a,b",1,Coal', T0, "a,b", 1.0, "Coal", False),
    ("2024-01-01T00:00:00,,1,", T0, None, 1.0, None, False),
    ("trading_interval,unit_id,generated_mw,fuel_type", None, "unit_id", None, "fuel_type", True),
]


@pytest.mark.parametrize("case", LINES, ids=[line[0] or "empty" for line in LINES])
def test_csv_edge_cases(spark, case):
    line, *fields, corrupt = case
    df = spark.createDataFrame([(line,)], "value string")
    row = bronze.parse_messages(df).first()
    assert list(row[:4]) == fields
    assert (row[4] is not None) is corrupt


def test_quarantine_splits_every_message(spark):
    df = spark.createDataFrame([(line[0],) for line in LINES], "value string")
    good, bad = bronze.parse_dispatch(df, quarantine=True)
    assert {r.unit_id for r in good.collect()} == {"U1", "a,b"}
    assert (good.count(), bad.count()) == (2, 8)
    assert good.columns == [f.name for f in schemas.BRONZE if f.name != "arrival"]
    everything, nothing = bronze.parse_dispatch(df)
    assert everything.count() == 10 and nothing is None
    assert everything.where("trading_interval = '2024-01-01'").first()["trading_date"] == date(2024, 1, 1)


def test_encoded_messages_parse_back(spark):
    df = spark.createDataFrame([(T0, 'a,"b"', 1.5, None), (T1, "U2", None, "Gas")], schemas.DISPATCH_MESSAGE)
    lines = sinks.encode_csv(df, df.columns, key="unit_id")
    assert lines.columns == ["key", "value"]
    good, _ = bronze.parse_dispatch(lines.drop("key"))
    assert rows(good.select(*df.columns)) == rows(df)


def test_json_leaves_null_fields_out(spark):
    df = spark.createDataFrame([("t", None)], "event_time string, solar_share double")
    assert sinks.encode_json(df, df.columns).first()["value"] == '{"event_time":"t"}'


def test_landed_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fuel_type,note,unit_id,generated_mw,trading_interval\nCoal,x,U1,2,2024-01-01 00:00:00\n")
    (tmp_path / "b.csv").write_text('unit_id,trading_interval,generated_mw\r\n"a,""b""",2024-01-01 00:00:00,x\r\n\r\n')
    (tmp_path / "c.csv").write_text("")
    found = readers.landing_feed(spark, str(tmp_path), schemas.DISPATCH_MESSAGE)
    assert rows(found) == [(T0, "U1", 2.0, "Coal"), (T0, 'a,"b"', None, None)]


def test_csv_fields_against_the_csv_module(spark):
    texts = [
        [["a", "b", "c"]], [["", "x", ""]], [["a,b", 'say "hi"', "end"]], [["one"]], [[" padded ", "1"]], [["x"] * 200],
        [['"', '""', ","]], [["y" * 5000, "z, " * 2000]],
    ]
    lines = []
    for (fields,) in texts:
        out = io.StringIO()
        csv.writer(out).writerow(fields)
        lines.append((out.getvalue().rstrip("\r\n"),))
    df = spark.createDataFrame(lines, "line string").coalesce(1)
    got = [r[0] for r in df.select(readers.csv_fields(F.col("line"))).collect()]
    assert got == [[f or None for f in fields] for (fields,) in texts]
    escaped = spark.createDataFrame([('a,"b \\"q\\" c"',)], "line string")
    assert escaped.select(readers.csv_fields(F.col("line"))).first()[0] == ["a", 'b "q" c']


def test_a_line_arrives_with_its_file_and_number(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n\nfour\n")
    found = readers.messages(spark, "text", str(tmp_path)).select("value", "arrival.offset", "arrival.time").collect()
    assert [(r[0], r[1]) for r in sorted(found, key=lambda r: r[1])] == [("one", 0), ("two", 1), ("", 2), ("four", 3)]
    assert all(r[2] is not None for r in found)


def test_a_broker_message_keeps_its_offset(spark):
    log = spark.createDataFrame([("k", bytearray(b"v"), "t", 2, 7, T0)], "key string, value binary, topic string, partition int, offset long, timestamp timestamp")
    found = readers.decode_value(log).first()
    assert (found.key, found.value, tuple(found.arrival)) == ("k", "v", (T0, "t/2", 7))


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(REGISTRY["solar_share"](spark, SMALL))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "props" not in scan.split("ReadSchema")[1]
    assert "Python" not in text


def test_message_stream_needs_its_source(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        readers.message_stream(spark, "kafka", **{"kafka.bootstrap.servers": "nowhere:9092", "subscribe": "t"})
