"""JDBC tables through Spark's own source; credentials come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """Options shared by reads and writes; ``user`` and ``password`` go in ``extra``."""
    return {"url": url, "dbtable": table, **extra}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    **extra: str,
) -> DataFrame:
    """Read a table, in parallel ranges of a numeric column when one is given."""
    options = jdbc_options(url, table, **extra)
    if split_column is not None:
        if bounds is None:
            raise ValueError("a split column needs its lower and upper bound")
        options.update(
            partitionColumn=split_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "errorifexists", **extra: str) -> None:
    """Write a table; columns are matched by name when appending."""
    df.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, **extra)).save()
