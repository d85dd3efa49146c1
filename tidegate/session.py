"""Session settings and the shared folder that streaming jobs write to."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a skewed join side is worth one more exchange when a key holds a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Window state of large key sets lives off-heap and is checkpointed as change files.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tidegate", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch folder only in local mode without one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tidegate-")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run, so that a query can be started again without meeting old state."""
    return f"{shared_root(spark)}/tidegate/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder of this run."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The n of all folders ``name=n`` in ``path``, rising: one listing, nothing is opened."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(jvm_path):
        return []
    listed = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files.listStatus(jvm_path)).toString()
    return sorted({int(n) for n in re.findall(rf"/{re.escape(name)}=(\d+)[;,\s]", listed)})
