"""SparkSession construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only fills in settings that are
unset. The checkpoint folder is always read from ``spark.checkpoint.dir``; a private folder is
created only when that setting is missing and the master is local (tests); on a cluster that raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings we rely on for correctness (UTC, NTZ timestamps) and for scale (AQE, skew joins).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable checkpoint files once their DataFrames are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
#: Planner sizes. A Parquet file's size says little about its rows in memory (dictionaries, compression, rows that are exploded later), so
#: tables of millions of rows would be planned as broadcasts, built on the driver and held by every task. What turns out
#: small after a shuffle is still broadcast by adaptive execution, which knows its true size.
SIZES = {"spark.sql.sources.fileCompressionFactor": "30",
         # shuffled bytes are compressed: a task's rows take some ten times as much when it sorts or groups them
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
#: The table queries' sizes. Adaptive execution only merges partitions, so a fixed small number of them grows with the tables: it starts
#: from many and merges them up to the size above (above 200, a task of the map side would keep and sort its rows).
TABLE_SIZES = SIZES | {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "bazaar", driver_memory: str = "8g") -> SparkSession:
    """Create (or get) a session. ``master`` is only applied for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession, sizes: dict[str, str] = SIZES) -> SparkSession:
    """Apply the correctness-relevant defaults to an existing session (only what is unset)."""
    if not spark.conf.get("spark.sql.session.timeZone", None):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in sizes.items():
        if not spark.conf.get(k, None):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # Spark Connect has no SparkContext
            d = None
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make ``df.checkpoint()`` usable: use ``spark.checkpoint.dir``; only when it is unset on a
    local master (tests on one machine) create a private folder."""
    try:
        sc = spark.sparkContext
    except Exception:
        return checkpoint_dir(spark)
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = checkpoint_dir(spark)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="bazaar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d


@contextmanager
def scratch(spark: SparkSession):
    """A function ``keep(df, name)`` that writes ``df`` once as Parquet to the shared folder and reads it back; Parquet takes a
    fraction of a checkpoint's bytes. The files go at the end of the block: what leaves it has to be checkpointed.

    The shuffles that made a kept table, and those of earlier steps, are of no more use, but Spark removes them only once the
    driver's garbage collector has found them unreferenced; with a large heap the disks may be full before, so it runs here."""
    ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(folder)

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.toString()}/{name}"
        jvm.System.gc()
        df.write.option("compression", "zstd").parquet(path)
        jvm.System.gc()
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        fs.delete(folder, True)
        fs.cancelDeleteOnExit(folder)
