"""Session construction and the shared (cluster-visible) working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at shuffle boundaries
# (broadcast when the measured side is small, split skewed partitions);
# runtime Bloom filters prune the big side of selective joins before the
# shuffle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one extra shuffle
    # (a hot product or order may hold a third of the lines).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", app: str = "opticart",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. A submitted job uses ``job_session``."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("OPTICART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def job_session(app: str = "opticart") -> SparkSession:
    """The session of a submitted job, or a local one if no master is configured.

    Whatever was submitted (master, shuffle partitions, memory) stays; of
    ``BASE_CONF`` only the settings that the submission leaves open are made.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    SparkContext._ensure_initialized()       # reads the submitted properties
    submitted = SparkConf()
    if not submitted.contains("spark.master"):
        return build_session(app=app)
    builder = SparkSession.builder
    if not submitted.contains("spark.app.name"):
        builder = builder.appName(app)
    for key, value in BASE_CONF.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or an already set
    SparkContext checkpoint dir). A local master may go without and gets a
    temporary folder; on a cluster that would be a folder the executors do
    not share, so there it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="opticart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder, deleted when the application ends."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([root, "opticart", *parts, uuid.uuid4().hex])
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)          # only an existing path can be marked
    fs.deleteOnExit(hadoop_path)
    return path
