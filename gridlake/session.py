"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on. Time arithmetic is done on UTC instants, AQE splits skewed join partitions even when
# that costs one more exchange, and stream state lives in RocksDB on local disk, with its changes in the checkpoint, so
# that many keys do not fill the heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster supplies its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gridlake")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options of :data:`SETTINGS` on a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Runtime options for a block; ``_`` stands for the dots of a name below ``spark.sql``."""
    names = {f"spark.sql.{name.replace('_', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder, wherever it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for staged tables and stream checkpoints, on storage every executor can reach.

    The root is the cluster's ``spark.checkpoint.dir``. Only a local master may run without it, on a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="gridlake-")
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
