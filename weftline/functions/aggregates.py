"""Averages with the empty-group rule of a sum/count pair, and SQL registration."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def average_or_nan(value: Column) -> Column:
    """Mean of the non-null values; NaN (0.0 / 0) where there are none.

    Partial sums and counts combine on the map side, so a hot group costs one
    row per task in the shuffle.
    """
    return F.coalesce(F.avg(value), F.lit(float("nan")))


def sum_count_average(value: Column) -> Column:
    """The same mean built from an explicit (sum, count) buffer."""
    total, rows = F.sum(value.cast("double")), F.count(value)
    return F.coalesce(total / F.nullif(rows, F.lit(0)), F.lit(float("nan")))


def register_average(spark: SparkSession, name: str = "my_average") -> None:
    """Register a SQL aggregate computed from (sum, count) buffers.

    The function takes sums and counts that were reduced by Spark beforehand,
    so a Python worker never sees more than the partial rows of a group.
    """

    @F.arrow_udf("double")
    def merge(totals: pa.Array, counts: pa.Array) -> float:
        total, rows = pc.sum(totals).as_py(), pc.sum(counts).as_py()
        return total / rows if rows else float("nan")

    spark.udf.register(name, merge)


def register_column_average(spark: SparkSession, name: str = "average_of") -> None:
    """Register a SQL aggregate over a plain column: ``SELECT key, average_of(x) FROM t GROUP BY key``.

    Nulls do not count, and a group without values has NaN.  A worker gets the
    values of one group at a time, 8 bytes each and nothing else of the rows, so
    a group must fit there.  Where one may not, :func:`register_average` takes
    the sums that Spark has reduced.
    """

    @F.arrow_udf("double")
    def mean(values: pa.Array) -> float:
        rows = len(values) - values.null_count
        return pc.sum(values.cast(pa.float64())).as_py() / rows if rows else float("nan")

    spark.udf.register(name, mean)
