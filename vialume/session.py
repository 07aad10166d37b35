"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that do not depend on the size of the cluster. Shuffle widths are left to the
# cluster's own defaults; adaptive execution merges or splits partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "vialume", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local session takes a
    folder of this machine and remembers it; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("vialume.shared.dir", None)
    if not path:
        master = spark.conf.get("spark.master", None) or "local"
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} can reach")
        path = tempfile.mkdtemp(prefix="vialume-")
        spark.conf.set("vialume.shared.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/vialume-{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
