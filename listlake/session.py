"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job wants; all of them can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chains of joins on one key: split a hot partition even if that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A merge looks for its keys in the lake through a Bloom filter, also where the source is too large for a
    # broadcast; the filter itself has a bounded number of bits.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    # A Python worker gets a few MB of rows at a time: 10,000 pages can be large, and an executor has a worker for
    # each core. Only a single row may be larger.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "listlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is used only where the setting is absent and the session is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="listlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created until a job writes to it."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove working tables that nothing reads any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
