"""What several operators of this package share: tables, written intermediate results, measured joins, word bytes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import discard, scratch_dir

# ASCII white space of the word contracts; ``bytes.split`` and ``bytes.strip`` use the same six.
SPACE = rb" \t\n\v\f\r"
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
A_TO_Z, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A written table with at most so many rows of a few numbers (tens of megabytes) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 500_000

_ITEM = bytes.maketrans(
    bytes(i for i in range(128) if not chr(i).isalnum()) + A_TO_Z.encode(),
    b" " * sum(not chr(i).isalnum() for i in range(128)) + LOWER.encode(),
)


# Rows of text that one Arrow batch takes to Python. Batches are what a worker holds besides its own work.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> None:
    """Let Arrow batches of the session hold at most ``BATCH_ROWS`` rows: texts are long, and memory is per batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TABLES: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what operators write on the way inside the block; results must have been written elsewhere."""
    paths: list[str] = []
    token = _TABLES.set(paths)
    try:
        yield
    finally:
        _TABLES.reset(token)
        for path in paths:
            discard(spark, path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts its lineage, survives lost executors, and is read column by column.

    A lazy result may read it later, so that it stays, unless the caller works inside :func:`cleared`.
    """
    path = scratch_dir(df.sparkSession, purpose)
    if (paths := _TABLES.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(small: DataFrame, rows: int | None = None) -> DataFrame:
    """A written narrow table, marked for broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(small) if (small.count() if rows is None else rows) <= BROADCAST_ROWS else small


def free(df: DataFrame, name: str) -> str:
    """A column name that begins like ``name`` and with which none of ``df`` begins."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name


def check_free(df: DataFrame, *names: str) -> None:
    """Refuse to overwrite columns of the input."""
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"columns {sorted(taken)} would be overwritten")


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def item_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_ITEM).split() if text else []


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Like ``written``, for a table that is deleted when the block ends."""
    path = scratch_dir(df.sparkSession, purpose)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        discard(df.sparkSession, path)
