"""Session helpers: defaults for local runs, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: times are read and printed in UTC, AQE may
# re-plan joins and coalesce shuffles at run time, and the Python state
# server talks over a unix socket instead of a TCP port.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.python.unix.domain.socket.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vigil") -> SparkSession:
    """A local session for tests and the bench (a cluster brings its own)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g"))
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_session_conf(spark: SparkSession) -> None:
    """Pin the SQL settings the definitions depend on (time zone above all)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a session in local mode, where driver and
    executors are one process, may go without it and gets a fresh local
    folder; on a cluster a missing setting is an error."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a shared folder (master {master} is not local)")
    local = tempfile.mkdtemp(prefix="vigil-ckpt-", dir=os.environ.get("VIGIL_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """The name of a new sub-folder of the checkpoint folder, for stream
    checkpoints, sinks and landing files (shared storage on a cluster). Spark
    makes the folder when it first writes there."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/vigil/{name}-{uuid.uuid4().hex}"
