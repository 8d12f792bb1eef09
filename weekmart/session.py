"""Session defaults and the shared scratch location.

Everything written as an intermediate (re-read tables, exports used by
checks, streaming checkpoints) goes under ``spark.checkpoint.dir`` -- the
shared folder the cluster names.  Only when that setting is absent (local
tests) do we pick a folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a weekly job relies on.  AQE re-plans joins/aggregations at
# run time (coalesces small shuffles, splits skewed partitions, turns a
# sort-merge join into a broadcast when the real side is small).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = "local[8]", app: str = "weekmart",
                  shuffle_partitions: int | None = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and ``shuffle_partitions=None`` so the
    cluster's own values stay in force.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _qualified(spark: SparkSession, path: str):
    """The folder as a Hadoop path with its scheme, and its file system: a path
    without a scheme belongs to the default file system, as Spark reads it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; also makes sure ``checkpoint()`` can use it."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        # A machine's own folder serves only where one machine does all the work.
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="weekmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return _qualified(spark, root)[0].toString().rstrip("/")


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    path, fs = _qualified(spark, f"{_checkpoint_root(spark)}/weekmart/{name}-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(path)
    return path.toString()
