"""A stored table as a stream of given batches: each batch is a folder that arrives as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from weftline.session import scratch_path


def files_of(spark: SparkSession, path: str):
    """The folder as the file system sees it: (file system, its path)."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def by_arrival(df: DataFrame, batch: Column, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Let the rows of ``df`` arrive batch by batch, and ``run`` a stream over what has come after each.

    One job writes a folder for every value of ``batch`` (whole numbers, not
    null), large ones as many files.  A folder is then moved to where the
    stream looks, and ``run`` is called with the stream; it must use the same
    checkpoint every time and process all there is.  So every folder is one
    micro-batch, and between two of them the query is stopped and restarted.
    Returns the last result; without rows the one of a stream without input.
    """
    spark = df.sparkSession
    stage, inbox = scratch_path(spark, "arrivals"), scratch_path(spark, "inbox")
    df.withColumn("_batch", batch.cast("bigint")).hint("rebalance", "_batch").write.partitionBy("_batch").parquet(stage)
    system, folder = files_of(spark, stage)
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    batches = sorted(int(name.partition("=")[2]) for name in names if name.startswith("_batch="))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(path(inbox))
    stream = spark.readStream.schema(df.schema).parquet(f"{inbox}/*")
    result = None
    for number in batches:
        if not system.rename(path(f"{stage}/_batch={number}"), path(f"{inbox}/b{number}")):
            raise OSError(f"batch {number} could not be moved to {inbox}")
        result = run(stream)
    return result if batches else run(stream)
