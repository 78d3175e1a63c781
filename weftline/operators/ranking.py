"""Global ranks and per-key top lists that never gather a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import cut_lineage


def top_per_key(df: DataFrame, key: str, order: list[Column], k: int, position: str | None = None) -> DataFrame:
    """First ``k`` rows per key.  Spark limits each group before the shuffle too."""
    name = position or "_position"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if position else kept.drop(name)


def global_rank(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Position (from 0) of every row in a total order, without a single-task window.

    Rows are range-partitioned and sorted, numbered within their partition and
    shifted by the sizes of the partitions before.  Those sizes are one row
    per partition.  The checkpoint fixes the partitioning both steps rely on.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        # The low 33 bits count the rows of the partition.
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_shift"))
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_shift") + F.col("_row"))
        .drop("_part", "_row", "_shift")
    )


def first_absent(
    present: DataFrame, keys: DataFrame, key: str, size: int, k: int, width: int = 4096
) -> DataFrame:
    """The ``k`` lowest ranks in ``[0, size)`` that each key lacks, as ``(key, rank)``.

    ``present`` holds distinct ``(key, rank)`` rows.  Ranks are counted in
    buckets of ``width``; the counts tell which buckets and gaps hold the
    first absent ranks, and only those are opened.  A key costs one row per
    bucket in a window, however many ranks it has.
    """
    marked = present.select(key, "rank", F.floor(F.col("rank") / width).cast("bigint").alias("bucket"))
    by_bucket = Window.partitionBy(key).orderBy("bucket")
    earlier = F.sum("n").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1))
    runs = (
        marked.groupBy(key, "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("below", F.coalesce(earlier, F.lit(0)))
        .withColumn("gap_from", (F.coalesce(F.lag("bucket").over(by_bucket), F.lit(-1)) + 1) * width)
        .withColumn("start", F.col("bucket") * width)
        .withColumn("stop", F.least(F.col("start") + width, F.lit(size).cast("bigint")))
    )

    def some_of(start: Column, stop: Column, absent_below: Column) -> Column:
        """The part of an absent stretch that can be among the first ``k``."""
        last = F.least(stop, start + (k - absent_below)) - 1
        return F.when(last >= start, F.sequence(start, last))

    gaps = runs.select(
        key, F.explode(some_of(F.col("gap_from"), F.col("start"), F.col("gap_from") - F.col("below"))).alias("rank")
    )
    partly = runs.filter(
        (F.col("start") - F.col("below") < k) & (F.col("n") < F.col("stop") - F.col("start"))
    ).select(key, "bucket", "start", "stop")
    opened = (
        partly.join(marked, [key, "bucket"])
        .groupBy(key, "bucket", "start", "stop")
        .agg(F.collect_set("rank").alias("taken"))
    )
    inside = opened.select(
        key, F.explode(F.array_except(F.sequence(F.col("start"), F.col("stop") - 1), "taken")).alias("rank")
    )
    ends = runs.groupBy(key).agg(F.max("bucket").alias("last"), F.sum("n").alias("n"))
    tails = keys.select(key).distinct().join(ends, key, "left").select(
        key,
        ((F.coalesce("last", F.lit(-1)) + 1) * width).cast("bigint").alias("start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    tail = tails.select(
        key, F.explode(some_of(F.col("start"), F.lit(size).cast("bigint"), F.col("start") - F.col("n"))).alias("rank")
    )
    return top_per_key(gaps.union(inside).union(tail), key, [F.col("rank")], k)
