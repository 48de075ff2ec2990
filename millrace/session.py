"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Zone-less parquet timestamps are instants here; watermarks need that.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep splitting skewed join keys even when a later operator could have
    # reused the join's partitioning: one more shuffle beats one huge task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Long texts travel to Python in batches of a few MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Plans may hold large literals; the driver keeps a description of every plan it has run.
    "spark.sql.maxPlanStringLength": "200000",
    # State lives on local disk with snapshots in the checkpoint, so its size
    # is not bounded by executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this package relies on to any session."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return tune(builder.getOrCreate())


def own_scratch(spark: SparkSession) -> SparkSession:
    """Name a new temporary folder as scratch where the session names none.

    For entry points, tests and benchmarks on one machine. Operators never call
    it: on a cluster the folder must be one that all executors can reach.
    """
    if not spark.conf.get(CHECKPOINT_CONF, None):
        spark.conf.set(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="millrace-"))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; an error if there is none."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


#: The folder of the run that is going on, if it is to be removed.
_RUN: ContextVar[str] = ContextVar("run", default="")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root; never reused."""
    return f"{scratch_root(spark)}/millrace/{_RUN.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to the scratch folder inside is removed at the end.

    Results are lazy and read it, so collect or write them inside as well.
    Without this it is left for the operator to clean.
    """
    run = f"{_RUN.get()}run-{uuid.uuid4().hex}/"
    folder, token = f"{scratch_root(spark)}/millrace/{run}", _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
