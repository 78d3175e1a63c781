"""Text, delimited, JSON, parquet and edge-list scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """One row per line; only ``\\n`` ends a line so texts stay whole.

    Files are split by size.  ``partitions`` spreads the lines over that many
    tasks for input that is one small file but much work per line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.repartition(partitions) if partitions else lines


def parse_fields(lines: DataFrame, sep: str, columns: dict[str, str]) -> DataFrame:
    """Split ``value`` at a literal separator and cast trimmed fields by position."""
    quoted = "\\Q" + sep + "\\E"
    fields = lines.select(F.split("value", quoted).alias("f"))
    return fields.select(
        *[F.trim(F.get("f", F.lit(i))).cast(kind).alias(name) for i, (name, kind) in enumerate(columns.items())]
    )


def string_schema(names: str) -> T.StructType:
    """Schema of nullable strings from space-separated names."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names.split(" ")])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows with a declared schema, so that no inference pass is needed."""
    return spark.read.schema(schema).json(path)


def write_key_folders(parts: dict[int, DataFrame], path: str, key: str = "key") -> None:
    """One ``key=N`` folder per frame; the frames may differ in columns."""
    for value, part in parts.items():
        part.write.mode("overwrite").parquet(f"{path}/{key}={value}")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Union of the column sets of all folders, plus the discovered key."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """Edges ``(src, dst, attr = 1)`` from lines of two ids; ``#`` lines are skipped and a line with one id is an error."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    ids = F.split(F.trim("value"), r"\s+")
    return lines.select(
        F.get(ids, F.lit(0)).cast("bigint").alias("src"),
        F.when(F.size(ids) > 1, F.get(ids, F.lit(1)).cast("bigint")).otherwise(
            F.raise_error(F.concat(F.lit("an edge needs two ids: "), F.col("value"))).cast("bigint")).alias("dst"),
        F.lit(1).alias("attr"),
    )
