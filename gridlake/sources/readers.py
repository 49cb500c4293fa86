"""Readers: message streams, metadata files and landed payload files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from gridlake.schemas import MESSAGE_LOG


def message_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Stream of messages: ``value`` and ``key`` as text, and ``arrival`` (:data:`gridlake.schemas.ARRIVAL`).

    Messages come from a broker topic, from a message log in files (``fmt="parquet"``, columns of
    :data:`gridlake.schemas.MESSAGE_LOG`), or line by line from landed text files (``fmt="text"``), whose lines have a
    ``place`` that :func:`arrived` makes their arrival of, batch by batch. Options go to the source unchanged; names with a
    dot are passed as ``**{"kafka.bootstrap.servers": ...}``. Kafka starts at the latest offsets unless told otherwise, as
    a new consumer of the dispatch feed does.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "latest")
    return _messages(reader, fmt, path, options)


def messages(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Batch form of :func:`message_stream`; lines have their arrival."""
    return arrived(_messages(spark.read.format(fmt), fmt, path, options))


def _messages(reader: DataFrameReader | DataStreamReader, fmt: str, path: str | None, options: dict) -> DataFrame:
    if fmt == "text":
        reader = reader.option("lineSep", "\n")
    elif fmt == "parquet":
        reader = reader.schema(MESSAGE_LOG)
    source = reader.options(**options).load(path) if path else reader.options(**options).load()
    return placed_lines(source) if fmt == "text" else decode_value(source)


def decode_value(df: DataFrame) -> DataFrame:
    """The payload as text (a broker delivers it as binary), with the message's key and arrival."""
    source = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    arrival = F.struct(
        F.col("timestamp").cast("timestamp").alias("time"), source.alias("source"), F.col("offset").alias("offset")
    )
    return df.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), arrival.alias("arrival")
    )


def placed_lines(df: DataFrame) -> DataFrame:
    """Lines of text files with their ``place``: the file's time and name, and the first byte of the block they lie in.

    A file of any size is read by as many tasks as it has blocks.
    """
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return df.select(F.regexp_replace("value", r"\r\z", "").alias("value"), place.alias("place"))


def arrived(df: DataFrame) -> DataFrame:
    """Messages with their ``arrival``: a line of a landed file arrives with the file and at its number in it.

    The blocks' numbers of lines, added up, say where each block begins; a line's number in its block comes from its
    task. Files are read once more for that, without their text. There are no more blocks than the driver plans anyway.
    """
    if "place" not in df.columns:
        return df
    rows = df.withColumn("__id", F.monotonically_increasing_id()).withColumns(
        {"__source": F.col("place.source"), "__block": F.col("place.block")}
    )
    before = Window.partitionBy("__source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("__source", "__block").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    blocks = sizes.select(
        "__source", "__block", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    arrival = F.struct("place.time", "place.source", (F.col("__id") + F.col("__shift")).alias("offset"))
    others = [c for c in df.columns if c != "place"]
    return rows.join(F.broadcast(blocks), ["__source", "__block"]).select(*others, arrival.alias("arrival"))


def once(messages: DataFrame, delay: str = "1 day") -> DataFrame:
    """Messages without those that an outbox sent again: the first of each ``key``. Messages without a key all stay.

    A stream remembers the keys of the last ``delay`` by the messages' times, which a replay has to come within.
    """
    keyed, others = messages.where(F.col("key").isNotNull()), messages.where(F.col("key").isNull())
    if not messages.isStreaming:
        return keyed.dropDuplicates(["key"]).unionByName(others)
    timed = keyed.withColumn("__time", F.col("arrival.time")).withWatermark("__time", delay)
    return timed.dropDuplicatesWithinWatermark(["key"]).drop("__time").unionByName(others)


def read_metadata(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema. Header names are checked against the schema."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def landing_feed(
    spark: SparkSession, path: str, columns: T.StructType, streaming: bool = False, delimiter: str = ","
) -> DataFrame:
    """Rows of landed CSV documents with a header, columns chosen by name.

    Every document may have columns of its own and its own order: its first line names them. A wanted column that a
    document lacks is NULL, as is a field that does not cast. Records do not span lines. A document of any size is read by
    many tasks; with ``streaming`` each must fit in a row, which :func:`gridlake.streaming.feed.run_feed` does not need.
    """
    if not streaming:
        return picked_rows(placed_lines(spark.read.option("lineSep", "\n").text(path)), columns, delimiter)
    reader = spark.readStream.format("text").option("wholetext", True)
    text = F.regexp_replace("value", r"\r?\n\z", "")
    lines = reader.load(path).where("value <> ''").select(F.split(text, r"\r?\n").alias("lines"))
    # The header is made before the explode: after it every line would carry the whole document.
    whole = lines.select(
        _names(F.col("lines")[0], delimiter).alias("header"), F.slice("lines", 2, F.size("lines")).alias("records")
    )
    return _picked(whole.select("header", F.explode("records").alias("line")), columns, delimiter)


def picked_rows(lines: DataFrame, columns: T.StructType, delimiter: str = ",") -> DataFrame:
    """The records of landed documents, given as lines with their ``place``.

    The first line of every file is found by its number in one light pass, and sent to the tasks that read the others:
    one row per file, of which the driver has the list anyway.
    """
    rows = lines.select(
        F.col("value").alias("line"),
        F.col("place.source").alias("source"),
        F.col("place.block").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    firsts = rows.groupBy("source").agg(F.min(F.when(F.col("block") == 0, F.col("id"))).alias("first"))
    named = rows.select("line", "id").join(F.broadcast(firsts), F.col("id") == F.col("first"))
    found = named.select("source", "first", _names(F.col("line"), delimiter).alias("header"))
    records = rows.join(F.broadcast(found), "source").where(F.col("id") != F.col("first"))
    return _picked(records, columns, delimiter)


def _names(line: Column, delimiter: str) -> Column:
    return F.transform(csv_fields(line, delimiter), lambda name: F.trim(name))


def _picked(records: DataFrame, columns: T.StructType, delimiter: str) -> DataFrame:
    rows = records.where(F.length(F.trim("line")) > 0).select("header", csv_fields(F.col("line"), delimiter).alias("fields"))

    def picked(field: T.StructField) -> Column:
        place = F.array_position("header", field.name).cast("int")
        return F.when(place > 0, F.get("fields", place - 1)).try_cast(field.dataType).alias(field.name)

    return rows.select(*[picked(f) for f in columns])


def csv_fields(line: Column, delimiter: str = ",") -> Column:
    """The fields of one CSV line, however many: quotes are taken off, doubled and escaped ones become one, and a field
    that is empty without quotes is NULL."""
    mark = re.escape(delimiter)
    field = rf'{mark}(?:"(?:[^"\\]++|""|\\.)*+"|[^{mark}]*+)'
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(field), F.lit(0))

    def plain(raw: Column) -> Column:
        value = F.substring(raw, len(delimiter) + 1, 1 << 30)
        unquoted = F.regexp_replace(
            F.regexp_replace(F.substring(value, F.lit(2), F.length(value) - 2), '""', '\\\\"'), r"\\(.)", "$1"
        )
        return F.when(value.startswith('"'), unquoted).when(value != "", value)

    return F.transform(found, plain)
