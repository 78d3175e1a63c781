"""Starting streams, and sinks that can be repeated after a failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.session import scratch_path
from weftline.sources.tables import table


# Files per micro-batch: enough to keep a cluster busy, few enough to redo after a failure.
FILES_PER_BATCH = 1000
# Micro-batches of a stream over files that are all there: each costs its planning and a commit of every state partition.
BATCHES = 8


def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A test table as a file stream; it may be one file or a folder of files."""
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    # As a glob the path is accepted by the file stream in both cases.
    return reader.parquet(f"{folder}/{name}.[p]arquet")


def staged_in_order(df: DataFrame, time: str, rows_per_file: int = 1_000_000) -> str:
    """Folder with one file for each range of ``time``, in the order in which a stream takes them.

    A stream over it meets no row that is older than a file it has read, so the
    watermark drops the same rows however many files make a batch.  One job
    writes all files: rows are dealt out by range of time and row number, so
    equal times are spread as well; rows without a time come first.  A file
    stream reads files by their modification time, which is set to the order of
    the ranges afterwards.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "ordered")
    files = max(1, -(-df.count() // rows_per_file))
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    numbered.repartitionByRange(files, F.col(time).asc_nulls_first(), "_row").drop("_row").write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    # Part files are numbered by their partition.
    parts = sorted((s.getPath().getName(), s) for s in system.listStatus(path) if s.getPath().getName().startswith("part-"))
    latest = max((s.getModificationTime() for _, s in parts), default=0)
    for place, (_, status) in enumerate(parts):
        # A second apart, which every file system can tell, and none in the future.
        system.setTimes(status.getPath(), latest - 1000 * (len(parts) - 1 - place), -1)
    return folder


def files_per_batch(spark: SparkSession, folder: str, batches: int = BATCHES) -> int:
    """Files of a folder of :func:`staged_in_order` to take at a time: all in about ``batches`` micro-batches, of bounded size."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    files = sum(status.getPath().getName().startswith("part-") for status in listed)
    return max(1, min(FILES_PER_BATCH, -(-files // batches)))


def stream_lines(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Lines of the text files that appear in a folder, with the folder's file time."""
    lines = spark.readStream.option("lineSep", "\n").options(**options).text(folder)
    return lines.selectExpr("value", "_metadata.file_modification_time AS timestamp")


def _start(writer, trigger: str | None, checkpoint: str):
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def run_append(stream: DataFrame, out: str, checkpoint: str | None = None) -> DataFrame:
    """Append to parquet with the file sink, whose commit log makes a batch count once."""
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-state")
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", out)
    _start(writer, None, checkpoint).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    mode: str = "append",
    checkpoint: str | None = None,
    trigger: str | None = None,
):
    """Hand every micro-batch to ``handle``.

    By default all available input is processed and the query ends; with a
    ``trigger`` interval the running query is returned.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-state")
    query = _start(stream.writeStream.outputMode(mode).foreachBatch(handle), trigger, checkpoint).start()
    if trigger is None:
        query.awaitTermination()
    return query


def run_recovering(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None, restarts: int = 3,
) -> int:
    """Process all available input; after a failure start again from the checkpoint, up to ``restarts`` times.

    The batch that failed is handed to ``handle`` again with the same rows and
    number, so a sink that replaces what it wrote under that number has every
    batch once.  Returns how often the query was started again; the failure
    after that is raised.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "stream-state")
    for tried in range(restarts + 1):
        try:
            run_batches(stream, handle, mode, checkpoint)
            return tried
        except StreamingQueryException:
            if tried == restarts:
                raise


def written(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """What batches have written below ``out``; empty where no batch has come yet."""
    try:
        return spark.read.schema(schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def batch_folder(out: str, batch_id: int) -> str:
    return f"{out}/batch_id={batch_id}"


def write_batch(frame: DataFrame, out: str, batch_id: int) -> None:
    """Write a batch to its own folder; a repeated batch replaces just that folder."""
    frame.write.mode("overwrite").parquet(batch_folder(out, batch_id))


def run_complete(stream: DataFrame, out: str, checkpoint: str | None = None) -> DataFrame:
    """Complete output: the whole result after every batch; returns the last one.

    Two folders take turns, so the previous result stays readable while the
    next one is written and storage does not grow with the number of batches.
    The number of a batch is written beside its result once that is there, so
    a restart without new input returns the result from before.
    """
    spark = stream.sparkSession

    def keep(frame: DataFrame, batch_id: int) -> None:
        turn = batch_id % 2
        write_batch(frame, f"{out}/result", turn)
        spark.range(1).select(F.lit(batch_id).cast("long").alias("done"), F.lit(turn).alias("turn")).coalesce(1).write.mode(
            "overwrite").parquet(f"{out}/done/turn_{turn}")

    run_batches(stream, keep, "complete", checkpoint)
    done = written(spark, f"{out}/done/*", StructType().add("done", "long").add("turn", "integer"))
    last = done.agg(F.max(F.struct("done", "turn")).alias("last")).select("last.turn").first()[0]
    if last is None:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(batch_folder(f"{out}/result", last))
