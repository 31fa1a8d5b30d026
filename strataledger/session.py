"""Session settings shared by jobs, tests and the registered queries."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings: no sizes of a particular cluster are fixed here. Shuffle partition counts are
# left to the session and to AQE, which coalesces small partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot account or a repeated id can hold a third of all rows. Splitting its join partition is
    # worth one more exchange when an aggregate follows the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Let a day's ids prune the scan of the accepted history before its shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    # Room for a day of 20 million ids in 20 MB. With more ids the filter passes more rows, and the
    # result stays the same; Spark adds it only where it would save a scan of 10 GB or more.
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "20000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "167772160",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # After a rebalance a task holds few dates: keep their files open instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# Joins broadcast a side up to this size by the planner's estimate, which for a stored table is the size of its compressed
# files: several times less than what passes through the driver. A session may set less, never more.
BROADCAST_CONF = "spark.sql.autoBroadcastJoinThreshold"
BROADCAST_BYTES = 256 << 10

# Settings that only a new session takes. Plans are built from many column expressions; the Python
# call-site capture for each of them is slow.
LAUNCH_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

SHARED_DIR_CONF = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", name: str = "strataledger", **conf: str) -> SparkSession:
    """Session on this machine, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    for key, value in {**settings, **LAUNCH_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call again on the same session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    held = spark.conf.get(BROADCAST_CONF)  # a negative number is none at all
    if not held.startswith("-") and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(held) > BROADCAST_BYTES:
        spark.conf.set(BROADCAST_CONF, str(BROADCAST_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    folder of this machine.
    """
    configured = spark.conf.get(SHARED_DIR_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_CONF} to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="strataledger-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.conf.set(SHARED_DIR_CONF, path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder. The application id in it tells whose leftovers a
    folder holds, should an application end before it removes them."""
    return os.path.join(shared_dir(spark), spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex}")
