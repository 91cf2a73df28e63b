"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on.

    Cluster sizing (executors, shuffle partitions, checkpoint folder) is left to
    spark-submit; ``master`` and ``conf`` are for tests and local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only used where the driver and the executors are
    the same process; on a cluster an unset folder is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not one_process(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    return _local_root()


def one_process(master: str) -> bool:
    """Whether driver and executors are one process; with ``local-cluster`` they are not."""
    return master == "local" or master.startswith("local[")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="harvestline-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; every call gives another one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
