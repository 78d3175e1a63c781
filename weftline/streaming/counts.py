"""Counts over streams: running, per batch, seeded, filtered and windowed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from weftline.operators.relational import broadcast_if_small
from weftline.streaming.runner import run_batches, write_batch, written


def running_counts(stream: DataFrame, *keys: str) -> DataFrame:
    """Count per key since the start; needs complete or update output."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def _per_batch(
    stream: DataFrame, result: Callable[[DataFrame], DataFrame], out: str, checkpoint: str | None, mode: str = "append"
) -> DataFrame:
    """Result of every batch with its ``batch_id``; no rows, but the same columns, where no batch has come."""
    run_batches(stream, lambda frame, batch_id: write_batch(result(frame), out, batch_id), mode, checkpoint)
    spark = stream.sparkSession
    schema = StructType(list(result(spark.createDataFrame([], stream.schema)).schema)).add("batch_id", "integer")
    return written(spark, out, schema)


def counts_per_batch(
    stream: DataFrame, out: str, *keys: str, checkpoint: str | None = None, sql: str | None = None
) -> DataFrame:
    """Counts of each micro-batch on its own, tagged with ``batch_id``.

    With ``sql`` the batch is counted by SQL text over the temp view ``batch``.
    """

    def counted(frame: DataFrame) -> DataFrame:
        if sql is None:
            return frame.groupBy(*keys).agg(F.count("*").alias("n"))
        frame.createOrReplaceTempView("batch")
        return frame.sparkSession.sql(sql)

    return _per_batch(stream, counted, out, checkpoint)


def unlisted_counts_per_batch(
    stream: DataFrame, listed: DataFrame, out: str, key: str = "word", checkpoint: str | None = None
) -> DataFrame:
    """Per-batch counts with a ``dropped`` flag on the listed keys.

    Dropped counts stay in the output, so their total survives a restart.
    """
    flags = broadcast_if_small(listed.select(key, F.lit(True).alias("hit")).distinct())

    def flagged(frame: DataFrame) -> DataFrame:
        counted = frame.groupBy(key).agg(F.count("*").alias("n")).join(flags, key, "left")
        return counted.select(key, "n", F.coalesce("hit", F.lit(False)).alias("dropped"))

    return _per_batch(stream, flagged, out, checkpoint)


def log_batches(stream: DataFrame, out: str, checkpoint: str | None = None) -> DataFrame:
    """One line of totals per micro-batch, appended under its batch id."""

    def total(frame: DataFrame) -> DataFrame:
        per_word = frame.groupBy("word").agg(F.count("*").alias("n"))
        return per_word.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.count("*").alias("n_distinct"))

    return _per_batch(stream, total, out, checkpoint)


def first_rows_per_batch(
    counted: DataFrame, out: str, *order: Column | str, n: int = 10, mode: str = "complete", checkpoint: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every batch result in a given order, as a printed preview shows them."""

    return _per_batch(counted, lambda frame: frame.orderBy(*order).limit(n), out, checkpoint, mode)


def with_seed(totals: DataFrame, seed: DataFrame) -> DataFrame:
    """Running totals that start from ``seed``; seeded keys show without input."""
    return totals.unionByName(seed).groupBy("word").agg(F.sum("n").alias("n"))


def update_by_key(
    stream: DataFrame, key: str, value: str, update: Callable[[int, int | None], int]
) -> DataFrame:
    """Keyed state changed by a Python function of (batch sum, old state).

    Each input partition is summed per key first, so a hot key sends one row
    per Arrow batch to its state task.  Null is a key like any other.  The
    function is called for the keys that a batch has, not for the others.
    Prefer ``running_counts`` where the function is a plain sum.
    """
    schema = f"{key} {dict(stream.dtypes)[key]}, total bigint"

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Arrow groups null keys like any other.
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by(key).aggregate([(value, "sum")]).select([key, f"{value}_sum"])
            yield from sums.rename_columns([key, "total"]).to_batches()

    def step(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        added = sum(int(frame["total"].sum()) for frame in frames)
        total = update(added, state.get[0] if state.exists else None)
        state.update((total,))
        yield pd.DataFrame({key: [group[0]], "total": [total]})

    partial = stream.select(key, F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias(value)).mapInArrow(combine, schema)
    return partial.groupBy(key).applyInPandasWithState(
        step, schema, "total bigint", "update", GroupStateTimeout.NoTimeout
    )


def updates_per_batch(updates: DataFrame, out: str, checkpoint: str | None = None) -> DataFrame:
    """What every batch has changed, with its ``batch_id``; for results of update output."""
    return _per_batch(updates, lambda frame: frame, out, checkpoint, "update")


def windowed_counts(
    stream: DataFrame, time: str, size: str, slide: str | None, *keys: str, watermark: str | None = None
) -> DataFrame:
    """Counts per event-time window and key; without ``slide`` windows do not overlap.

    With a watermark, append output emits a window once it is closed and drops
    later rows; complete output keeps everything.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    if watermark is not None:
        timed = timed.withWatermark(time, watermark)
    window = F.window(time, size, slide or size)
    return (
        timed.groupBy(window.alias("window"), *keys)
        .agg(F.count("*").alias("n"))
        .select(
            F.unix_seconds("window.start").alias("start_s"), F.unix_seconds("window.end").alias("end_s"), *keys, "n"
        )
    )


def check_window(size_seconds: int, slide_seconds: int | None = None) -> tuple[str, str]:
    """Window durations; a slide longer than the window is refused."""
    slide_seconds = size_seconds if slide_seconds is None else slide_seconds
    if slide_seconds > size_seconds:
        raise ValueError("the slide must not be longer than the window")
    return f"{size_seconds} seconds", f"{slide_seconds} seconds"
