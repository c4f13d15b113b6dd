"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings the operators rely on. Sizes (memory, shuffle partitions, executors) belong to
# the cluster; AQE splits and coalesces the shuffles at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Bytes of an Arrow batch for functions on values, which hold each value as a Python object too: the usual 10,000 rows are
# hundreds of megabytes a worker where values are whole texts. Can be set while a session runs.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "2000000")


def build_session(app_name: str = "changeloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory below ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session without it is
    refused, because executors cannot share a machine-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    scratch_dir(df.sparkSession, "probe")
    return df.checkpoint(eager=True)
