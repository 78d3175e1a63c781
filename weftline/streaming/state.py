"""Keyed state that every batch sees in full: silent keys, removal, state from before the first batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.streaming.arrivals import files_of
from weftline.streaming.runner import batch_folder, run_batches, write_batch, written

# (sum of the batch, null without input; total so far, null for a new key; batches since the last input) to the new total.
Update = Callable[[Column, Column, Column], Column]


def added_up(added: Column, total: Column, idle: Column) -> Column:
    return F.coalesce(added, F.lit(0)) + F.coalesce(total, F.lit(0))


def update_all_keys(
    stream: DataFrame, key: str, value: str, out: str, update: Update = added_up, seed: DataFrame | None = None,
    checkpoint: str | None = None, history: bool = True,
) -> DataFrame:
    """State of all keys after every batch: ``key``, ``total`` (long), ``idle`` and ``batch_id``.

    ``update`` is called for every key of the state or the batch, so totals of
    keys without input can change too; a null total removes the key, and one
    that comes again later is new.  ``seed`` (``key``, ``total``) is the state
    before the first batch.  Null is a key like any other.

    A batch's sums combine before they are shuffled and meet the state in one
    join.  The state after batch n is a folder of its own, made from that of
    batch n - 1 only, so a batch that is repeated after a failure gives the
    same.  Without ``history`` only the last two are kept.
    """
    spark = stream.sparkSession
    kind = dict(stream.dtypes)[key]
    schema = f"{key} {kind}, total bigint, idle bigint"
    start = spark.createDataFrame([], schema) if seed is None else seed.select(
        F.col(key).cast(kind).alias(key), F.col("total").cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("idle"))

    def step(frame: DataFrame, batch_id: int) -> None:
        added = frame.groupBy(F.col(key).alias("_key")).agg(F.sum(F.col(value).cast("bigint")).alias("_added"), F.lit(True).alias("_came"))
        old = start if batch_id == 0 else spark.read.schema(schema).parquet(batch_folder(out, batch_id - 1))
        both = old.withColumn("_was", F.lit(True)).join(added, F.col(key).eqNullSafe(F.col("_key")), "full")
        idle = F.when(F.col("_came"), F.lit(0)).otherwise(F.col("idle") + 1).cast("bigint")
        new = both.select(
            F.when(F.col("_was"), F.col(key)).otherwise(F.col("_key")).alias(key),
            update(F.col("_added"), F.col("total"), idle).cast("bigint").alias("total"), idle.alias("idle"))
        write_batch(new.where(F.col("total").isNotNull()), out, batch_id)
        if not history and batch_id >= 2:
            system, folder = files_of(spark, batch_folder(out, batch_id - 2))
            system.delete(folder, True)

    run_batches(stream, step, checkpoint=checkpoint)
    return written(spark, out, spark.createDataFrame([], f"{schema}, batch_id int").schema)
