"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Only settings the jobs rely on; sizing (executors, memory) belongs to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # The JVM never compiles methods over 8,000 bytes; wide projections are better split than fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Commit the changes of a batch instead of whole state files.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: State of streams: keyed state and timers need RocksDB, and its memory outside the heap is bounded for all stores of a worker. A stream
#: restarts from its last batch, so the files of a few batches are enough; 100 hold all that has passed through the state.
STATE_SETTINGS = {k: v for k, v in SETTINGS.items() if k.startswith("spark.sql.streaming.stateStore.")} | {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.minBatchesToRetain": "4",
    # One store for a join instead of four; a checkpoint keeps the form that it began with.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}

_local_folders: list[tempfile.TemporaryDirectory] = []
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a work folder, wherever it lies."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the work folders made inside, once all inside has been written elsewhere; after an error they stay."""
    folders: list[str] = []
    outer = _scratch.set(folders)
    try:
        yield
    finally:
        _scratch.reset(outer)
    for path in folders:
        remove(spark, path)


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state as the jobs need it, whatever the session is set to; it is left as it was."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    try:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(name: str, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for checkpoints and staged tables.

    It lies under ``spark.checkpoint.dir``, which all executors share. Where that is unset, only a
    local session may use a temporary folder of its own machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    noted = _scratch.get()
    if shared:
        path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        if noted is not None:
            noted.append(path)
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.TemporaryDirectory(prefix=f"snapline-{name}-")
    _local_folders.append(folder)
    if noted is not None:
        noted.append(folder.name)
    return folder.name


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; keeps a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(shared or work_dir(spark, "checkpoint"))
