"""Joining the small files of closed days, so that a stop at any point loses and doubles nothing for good.

A run chooses files, writes their rows as few larger files beside the table, and then a plan: which files come, which go.
Once the plan is written the swap can be done, and done again from the start, as each step leaves what is already done. A run
begins with the plan that an earlier one may have left: a complete plan is finished, anything else is dropped. Readers may
see rows twice only while a swap is under way. No stream may write to the chosen days meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import discard

# Files below half of it are joined up to it.
TARGET_BYTES = 256 << 20
CLOSED = "closed"
PLAN = "action string, bin int, folder string, path string"


class File(NamedTuple):
    """A data file: its partition's folder below the table, name and size."""

    folder: str
    name: str
    size: int


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _files(spark: SparkSession, location: str, folders: list[str]) -> list[File]:
    """Data files of partition folders, from the file system's lists; no file is opened."""
    found = []
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/{folder}")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in system.listStatus(path) if system.exists(path) else []:
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                found.append(File(folder, name, status.getLen()))
    return found


def packed(files: list[File], target: int) -> list[list[File]]:
    """Bins of at most ``target`` bytes, the largest files first, each into the first bin with room."""
    bins: list[list[File]] = []
    room: list[int] = []
    for file in sorted(files, key=lambda f: (-f.size, f)):
        for at, left in enumerate(room):
            if file.size <= left:
                break
        else:
            at = len(bins)
            bins.append([])
            room.append(target)
        bins[at].append(file)
        room[at] -= file.size
    return bins


def closed_folders(spark: SparkSession, table: str, day: str, before: str, since: str | None) -> dict[str, list[str]]:
    """Partition folders of the days before ``before``, by day."""
    found: dict[str, list[str]] = {}
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in row[0].split("/"))
        if (since or "") <= values[day] < before and values[day] != "__HIVE_DEFAULT_PARTITION__":
            found.setdefault(values[day], []).append(row[0])
    return found


def _chosen(
    spark: SparkSession, location: str, days: dict[str, list[str]], batch: str | None, target: int
) -> tuple[list[tuple[str, list[File]]], list[tuple[str, File]]]:
    """Bins of files to join, and files to move as they are, each with the folder they go to."""
    bins, moved = [], []
    for folders in days.values():
        files = _files(spark, location, folders)
        if batch:
            # All of a day goes to one partition, where large files need not be written anew.
            into = f"{folders[0].rsplit('/', 1)[0]}/{batch}={CLOSED}"
            small = [f for f in files if f.size < target // 2]
            joined = [b for b in packed(small, target) if len(b) > 1]
            known = {f for b in joined for f in b}
            moved += [(into, f) for f in files if f not in known and f.folder != into]
            bins += [(into, b) for b in joined]
        else:
            for folder in folders:
                small = [f for f in files if f.folder == folder and f.size < target // 2]
                bins += [(folder, b) for b in packed(small, target) if len(b) > 1]
    return bins, moved


def _staged(spark: SparkSession, location: str, bins: list[tuple[str, list[File]]], folder: str) -> None:
    """Write the rows of every bin to ``folder/bin=...``."""
    names = [(f"{f.folder}/{f.name}", at) for at, (_, files) in enumerate(bins) for f in files]
    paths = [f"{location}/{name}" for name, _ in names]
    rows = spark.read.option("basePath", location).parquet(*paths)
    parts = [c for c in names[0][0].split("/") if "=" in c]
    place = F.regexp_extract("_metadata.file_path", rf"((?:[^/]+/){{{len(parts)}}}[^/]+)$", 1)
    # One row per file; the driver has the list.
    known = spark.createDataFrame(names, "__name string, bin int")
    met = rows.withColumn("__name", place).join(F.broadcast(known), "__name")
    columns = [c for c in rows.columns if c not in {p.split("=", 1)[0] for p in parts}]
    met.select(*columns, "bin").hint("rebalance", F.col("bin")).write.partitionBy("bin").parquet(folder)


def steps(
    spark: SparkSession,
    table: str,
    day: str,
    before: str,
    batch: str | None = None,
    since: str | None = None,
    target: int = TARGET_BYTES,
) -> Iterator[str]:
    """The steps of :func:`compact`, one for each ``next``; a stop after any of them is mended by the next run."""
    location = table_location(spark, table)
    root = f"{location}__compaction"
    yield from _finished(spark, table, location, root)
    days = closed_folders(spark, table, day, before, since)
    bins, moved = _chosen(spark, location, days, batch, target)
    if not bins and not moved:
        return
    run = f"{root}/{uuid.uuid4().hex[:12]}"
    if bins:
        _staged(spark, location, bins, f"{run}/rows")
    yield "staged"
    plan = [("join", at, into, "") for at, (into, _) in enumerate(bins)]
    plan += [("move", -1, into, f"{f.folder}/{f.name}") for into, f in moved]
    plan += [("drop", at, f.folder, f"{f.folder}/{f.name}") for at, (_, files) in enumerate(bins) for f in files]
    spark.createDataFrame(plan, PLAN).coalesce(1).write.parquet(f"{run}/plan")
    yield "planned"
    yield from _finished(spark, table, location, root)


def _finished(spark: SparkSession, table: str, location: str, root: str) -> Iterator[str]:
    """Finish every complete plan below ``root`` and drop the rest."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(root)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(top) if system.exists(top) else []:
        run = status.getPath().toString()
        if system.exists(hadoop.Path(f"{run}/plan/_SUCCESS")):
            plan = spark.read.schema(PLAN).parquet(f"{run}/plan").collect()
            yield from _swapped(spark, table, location, run, plan, system)
        discard(spark, run)
        yield "cleared"


def _swapped(
    spark: SparkSession, table: str, location: str, run: str, plan: list[Any], system: Any
) -> Iterator[str]:
    hadoop = spark._jvm.org.apache.hadoop.fs
    mark = run.rsplit("/", 1)[1]

    def move(source: Any, folder: str, name: str) -> None:
        target = hadoop.Path(f"{location}/{folder}/{name}")
        system.mkdirs(target.getParent())
        if system.exists(source) and not system.exists(target):
            system.rename(source, target)

    for folder in sorted({r["folder"] for r in plan if r["action"] in ("join", "move")}):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(folder)})")
    for row in plan:
        if row["action"] == "join":
            rows = hadoop.Path(f"{run}/rows/bin={row['bin']}")
            for status in system.listStatus(rows) if system.exists(rows) else []:
                name = status.getPath().getName()
                if not name.startswith(("_", ".")):
                    move(status.getPath(), row["folder"], f"{mark}-{row['bin']}-{name}")
        elif row["action"] == "move":
            # The batch keeps equal names of different batches apart.
            before = row["path"].rsplit("/", 2)[1].split("=", 1)[1]
            move(hadoop.Path(f"{location}/{row['path']}"), row["folder"], f"{before}-{row['path'].rsplit('/', 1)[1]}")
    yield "added"
    for row in plan:
        if row["action"] == "drop":
            system.delete(hadoop.Path(f"{location}/{row['path']}"), False)
    yield "dropped"
    for folder in sorted({r["path"].rsplit("/", 1)[0] for r in plan if r["path"]}):
        if not _files(spark, location, [folder]):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(folder)})")
    spark.catalog.refreshTable(table)
    yield "swapped"


def _spec(folder: str) -> str:
    return ", ".join(f"{name} = '{value}'" for name, value in (part.split("=", 1) for part in folder.split("/")))


def compact(spark: SparkSession, table: str, day: str, before: str, **options: Any) -> None:
    """Join the small files of the days before ``before`` in a table partitioned by ``day``, up to ``target`` bytes.

    With ``batch``, the last partition column, all files of a day come into one partition of that column, ``closed``; large
    ones only move. Only the days from ``since`` on are listed, when given.
    """
    for _ in steps(spark, table, day, before, **options):
        pass


def file_sizes(df: DataFrame) -> DataFrame:
    """``path, size`` of the files that hold rows of ``df``, a table or a part of one."""
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
