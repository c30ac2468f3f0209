"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE does the work a fixed plan cannot: it coalesces shuffle partitions, turns a sort-merge join
# into a broadcast join once the real size of a side is known, and splits skewed join partitions.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Call-site capture costs several round trips to the JVM per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Sessions are pre-merged inside each map partition before the per-vehicle shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder: SparkSession.Builder, **overrides: str) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder; keyword values win."""
    for key, value in {**CLUSTER_SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder


_LOCAL_SCRATCH: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="rodovia-")
    return _LOCAL_SCRATCH[app]


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark).rstrip('/')}/rodovia-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in a folder of this application."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done with.

    Its cleaner does so when the driver's JVM collects them, which a driver with little garbage may put off until the executors'
    disks hold the shuffles of all steps at once. Python's own garbage goes first, for it holds on to plans.
    """
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Delete the files in the shared folder that ``df`` reads, when nothing is to read them any more; other files stay."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(_scratch_root(spark))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(root)
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        folder = fs.makeQualified(path(folder))
        if folder.getParent().equals(root):
            fs.delete(folder, True)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete all that this application has put into the shared folder; whether there was anything.

    Results are lazy and read what lies there, so this is for the end, when they have been written.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
