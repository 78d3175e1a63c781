"""Cell tables in regions of the key space, for reading single rows.

Below a table's path, ``splits`` has the row keys at which regions begin and
``cells`` one folder per load, region and family.  Files are sorted by key and
have bloom filters on it, so a few keys read the folders of their regions and,
in these, the row groups that may have them.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.cells import CELL_SCHEMA
from weftline.operators.regions import region_of
from weftline.operators.relational import broadcast_if_small
from weftline.session import at_most

# Keys that are named one by one in the filter of a scan; more of them are joined.
NAMED_KEYS = 1000
# Rows of a parquet row group are counted in bytes; small groups make single rows cheap.
GROUP_BYTES = 8 << 20


def even_splits(cells: DataFrame, regions: int) -> list[bytes]:
    """Row keys that cut the table into about equal regions; fewer where a key is in most rows."""
    placed = cells.select("row_key").repartitionByRange(regions, "row_key")
    firsts = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.min("row_key").alias("low")).collect()
    # One row per region, by construction.
    return sorted({bytes(r["low"]) for r in firsts})[1:]


def create_regions(spark: SparkSession, path: str, splits: list[bytes]) -> None:
    """A new, empty table whose regions begin at ``splits``; every load uses them."""
    rows = [(bytearray(point),) for point in sorted(set(splits))]
    spark.createDataFrame(rows, "low binary").coalesce(1).write.mode("errorifexists").parquet(f"{path}/splits")


def splits_of(spark: SparkSession, path: str) -> list[bytes]:
    return sorted(bytes(r["low"]) for r in spark.read.schema("low binary").parquet(f"{path}/splits").collect())


def load_regions(cells: DataFrame, path: str, keys_per_file: int = 1_000_000) -> None:
    """Add cells to the table; the load shows up as a whole when its job commits.

    Rows are dealt out by ranges of key, qualifier and version, so neither a
    region nor a row with very many cells is one task's work.  ``keys_per_file``
    sizes the bloom filters.
    """
    order = ["row_key", "family", "qualifier", F.desc("version")]
    placed = cells.withColumn("region", region_of(F.col("row_key"), splits_of(cells.sparkSession, path)))
    placed.repartitionByRange(*order).sortWithinPartitions("region", "family", *order).write.partitionBy("region", "family").options(**{
        "parquet.bloom.filter.enabled#row_key": "true", "parquet.bloom.filter.expected.ndv#row_key": str(keys_per_file),
        "parquet.bloom.filter.adaptive.enabled": "true", "parquet.block.size": str(GROUP_BYTES),
    }).parquet(f"{path}/cells/load={uuid.uuid4().hex}")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all cells, with the region of their row; filters on region and family prune folders."""
    stored = spark.read.schema(CELL_SCHEMA + ", region int, load string").parquet(f"{path}/cells")
    return stored.select("row_key", "family", "qualifier", "version", "value", "region")


def cells_of_keys(spark: SparkSession, path: str, keys: DataFrame, named: int = NAMED_KEYS) -> DataFrame:
    """Cells of the given row keys (a frame with ``row_key`` bytes; repeats and nulls count for nothing).

    Up to ``named`` keys become a filter on region and key, which the scan uses
    on folders, row groups and bloom filters.  More of them are joined on region
    and key; where their regions are few, the join prunes folders at run time.
    """
    wanted = keys.select("row_key").where(F.col("row_key").isNotNull()).distinct()
    stored, splits = read_regions(spark, path), splits_of(spark, path)
    if at_most(wanted, named):
        found = sorted(bytes(r["row_key"]) for r in wanted.collect())
        regions = sorted({bisect_right(splits, key) for key in found})
        return stored.where(F.col("region").isin(regions) & F.col("row_key").isin([bytearray(k) for k in found])).drop("region")
    placed = wanted.withColumn("region", region_of(F.col("row_key"), splits))
    return stored.join(broadcast_if_small(placed), ["region", "row_key"], "left_semi").drop("region")
