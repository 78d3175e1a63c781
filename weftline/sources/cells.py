"""Cell tables in parquet: one folder per load, below it one per family."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.cells import CELL_SCHEMA, latest


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all cells.  Family filters prune folders."""
    if not path:
        raise ValueError("a cell table needs a path")
    stored = spark.read.schema(CELL_SCHEMA + ", load string").parquet(path)
    return stored.select("row_key", "family", "qualifier", "version", "value")


def _commit(cells: DataFrame, path: str) -> None:
    # Readers skip the committer's hidden work folder, so a load shows up as a
    # whole when its job commits and a failed one never does.
    cells.write.partitionBy("family").parquet(f"{path}/load={uuid.uuid4().hex}")


def append_cells(cells: DataFrame, path: str) -> None:
    """Upsert: newer versions replace older ones when the table is read."""
    if not path:
        raise ValueError("a cell table needs a path")
    _commit(cells, path)


def bulk_load(cells: DataFrame, path: str, partitions: int | None = None) -> None:
    """Load files that are range-partitioned and sorted by key.

    Sorted files give every row group a narrow key range, which is what makes
    key filters skip data.  The range takes in qualifier and version, so a row
    with very many cells, or a cell with very many versions, is spread over
    several tasks.
    """
    order = ["row_key", "family", "qualifier", F.desc("version")]
    ranged = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    _commit(ranged.sortWithinPartitions(*order), path)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite only the newest version of each cell, sorted, to another table."""
    newest = latest(read_cells(spark, path)).select("row_key", "family", "qualifier", "version", "value")
    bulk_load(newest, target)
