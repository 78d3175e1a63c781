"""Session construction and the shared scratch folder used by every job."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes of rows that a Python worker gets at a time; a longer row comes alone.
BATCH_BYTES = 4 << 20
# Shuffle files of an action go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "weftline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    AQE does partition coalescing and skew-join splitting at run time.  It may
    add a shuffle to split a hot key, because a straggler costs more than the
    extra exchange.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        CLEANUP: "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Settings the operators rely on, for sessions that were built elsewhere.

    Event times are UTC.  A hot join key is split at run time even where that
    costs an extra exchange.  A query of many jobs holds the shuffle files of
    one at a time.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set(CLEANUP, "true")


def bound_batches(spark: SparkSession) -> None:
    """Have rows go to Python workers a few MB at a time, however large the partitions are.

    By default a batch takes up to 10,000 rows, of long texts tens of MB.  Every
    task holds it several times: in the executor as buffers that grow by doubling,
    and in its worker, beside what an operator makes of it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A machine-local temporary folder is only acceptable when driver and
    executors are one process, i.e. with a ``local`` master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_root(spark)}/weftline-{label}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the shared folder's file system drop a scratch folder when the program ends."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def have_checkpoints(spark: SparkSession) -> None:
    """Give checkpoints a folder below the shared one, unless they have one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoint"))
        remove_at_exit(spark, context.getCheckpointDir())


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and truncates the plan."""
    have_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def collecting(spark: SparkSession, seconds: float = 5.0) -> Iterator[None]:
    """Have the driver collect its garbage now and then, and at the end.

    Spark deletes the shuffle files and cached blocks of RDDs once the driver has
    collected them.  A driver with room for its objects would not for a long time.
    """
    over = threading.Event()

    def collect() -> None:
        while not over.wait(seconds):
            spark.sparkContext._jvm.System.gc()

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back.

    Unlike a cache it survives lost executors, and unlike a checkpoint the
    readers still prune columns and push filters down.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    remove_at_exit(df.sparkSession, path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.staged_at = path
    return kept


def release(staged_frame: DataFrame) -> None:
    """Delete the files of a frame of :func:`staged` that nothing reads any more, while the program goes on."""
    spark = staged_frame.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged_frame.staged_at)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, without counting past them."""
    return df.limit(rows + 1).count() <= rows
