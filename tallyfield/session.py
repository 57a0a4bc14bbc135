"""Session settings, shared work folder and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key (an event with a third of all candidates) is split at run time,
    # also when the split costs one more shuffle further up
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every plan of this package relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "8", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the local bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyfield")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # no call-site capture per column expression: it costs several round trips to the JVM each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster the
    setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has separate executors
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = getattr(shared_dir, "local", None)
    if made is None:
        made = shared_dir.local = tempfile.mkdtemp(prefix="tallyfield-")
    return made


SCRATCH = threading.local()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    if getattr(SCRATCH, "open", None):
        SCRATCH.open[-1].append(path)
    return path


def released(spark: SparkSession, build: Callable[[], DataFrame], label: str = "result") -> DataFrame:
    """Store what `build` returns, then delete every table that `build` stored on the way."""
    SCRATCH.open = [*getattr(SCRATCH, "open", []), made := []]
    try:
        result = build()
    except BaseException:
        discard(spark, made)
        raise
    finally:
        SCRATCH.open = SCRATCH.open[:-1]
    kept = stored(result, label)
    discard(spark, made)
    return kept


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables in the shared folder, whatever its file system."""
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str = "table", **options) -> DataFrame:
    """Write a (small) intermediate table to the shared folder and read it back.

    Histograms filled from the event tables are used several times by the algebra;
    stored once, the event tables are read once, a lost executor costs nothing,
    and the optimizer knows the true size when it picks join strategies.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 16 << 20  # of compressed Parquet, several times that in memory


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Side of a join that is expected to be small (one row per bin, per file).

    It is stored, and its rows and bytes are counted.  Within both limits it is broadcast, so
    the event table on the other side is not shuffled; beyond, it is returned as it is
    and the optimizer picks a shuffled join, which handles skew.
    """
    kept = stored(df, "side")
    files = kept.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    size = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return F.broadcast(kept) if size["rows"] <= max_rows and size["bytes"] <= max_bytes else kept
