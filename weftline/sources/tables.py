"""Test-table access and catalog tables: managed, external, partitioned."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def listed(spark: SparkSession, column: str, values: list[str]) -> DataFrame:
    """A short list of given values as a frame of one column."""
    return spark.range(1).select(F.explode(F.array(*map(F.lit, values))).alias(column))


def widened(df: DataFrame) -> DataFrame:
    """Spread a small scan over all cores, for work that is heavy per row.

    A scan has fewer partitions than the cluster has cores only when it is
    smaller than one split per core, so the exchange is cheap; larger scans
    come back unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def register_views(spark: SparkSession, folder: str, *names: str) -> None:
    """Temp views over the named tables, for SQL text."""
    for name in names:
        table(spark, folder, name).createOrReplaceTempView(name)


def scratch_database(spark: SparkSession) -> str:
    """A database whose managed tables live in the shared folder."""
    name = f"weft_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def save_managed(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Write a managed parquet table and return it as read from the catalog."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def save_partitioned(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Dynamic-partition write; the partition columns move to the end.

    Rows are gathered by key so that a key becomes few files.  Rebalancing
    splits a key that is too large for one task by size, whatever its rows
    look like, and puts small keys together.
    """
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def create_external(spark: SparkSession, name: str, schema: str, location: str) -> DataFrame:
    """Declare a table over a parquet folder that already holds data."""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def load_delimited(spark: SparkSession, name: str, schema: str, path: str, sep: str = "\x01") -> DataFrame:
    """Append a delimited file to a table that is created when missing."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")
    spark.read.csv(path, schema=schema, sep=sep).write.insertInto(name)
    return spark.table(name)
