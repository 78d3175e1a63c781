"""Filters, joins and aggregates that need more than one built-in call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import BLANKS
from weftline.session import at_most

# Largest lookup side that is broadcast; beyond it Spark shuffles both sides.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after the row count was checked."""
    return F.broadcast(df) if at_most(df, rows) else df


def count_containing(df: DataFrame, column: str, *needles: str) -> DataFrame:
    """Rows containing each substring, all counted in one pass."""
    return df.agg(*[F.count_if(F.col(column).contains(n)).alias(f"n_{n}") for n in needles])


def members(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (semi join, no collected set)."""
    return df.join(keys, on, "left_semi")


def first_tab_fields(line: Column) -> tuple[Column, Column]:
    """Text before the first tab and the trimmed rest; NULL rest without a tab."""
    at = F.locate("\t", line)
    head = F.when(at > 0, F.substring(line, F.lit(1), at - 1))
    tail = F.when(at > 0, F.substring(line, at, F.length(line)))
    return head, F.btrim(tail, F.lit(BLANKS))


def strict_int(text: Column) -> Column:
    """Integer of plain digits, NULL otherwise (no inner or outer blanks)."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def parse_catalog(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id <tab> name`` lines; lines without tab or integer id are dropped."""
    head, name = first_tab_fields(F.col(column))
    return lines.select(strict_int(head).alias("id"), name.alias("name")).filter(
        F.col("id").isNotNull()
    )


def parse_alias(lines: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """``bad <tab> good`` id pairs, with the columns to keep; lines with an empty or bad field are dropped."""
    fields = F.split(F.col(column), "\t")
    return lines.select(
        strict_int(F.get(fields, F.lit(0))).alias("bad"),
        strict_int(F.get(fields, F.lit(1))).alias("good"), *keep,
    ).filter("bad IS NOT NULL AND good IS NOT NULL")


def last_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key: the one that comes last in ``order``."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def canonical_ids(df: DataFrame, column: str, alias: DataFrame) -> DataFrame:
    """Replace ids by their alias target where there is one.

    ``alias`` has unique ``bad`` keys.  It is broadcast only when its checked
    size allows it; a join on a hot id otherwise splits under AQE.
    """
    small = broadcast_if_small(alias.select(F.col("bad").alias(column), "good"))
    rest = [c for c in df.columns if c != column]
    return df.join(small, column, "left").select(
        F.coalesce("good", column).alias(column), *rest
    )


def drop_listed(df: DataFrame, listed: DataFrame, on: str) -> DataFrame:
    """Anti join against a list that is broadcast when small."""
    return df.join(broadcast_if_small(listed), on, "left_anti")


def column_statistics(df: DataFrame, *columns: str) -> DataFrame:
    """count, mean, population stdev, max and min of each column, one row each.

    All columns are aggregated in a single pass and unpivoted afterwards.
    """
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("field"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_pop(c).alias("stdev"),
                F.max(c).cast("double").alias("max"),
                F.min(c).cast("double").alias("min"),
            ).alias(c)
            for c in columns
        ]
    )
    return one_row.select(F.inline(F.array(*columns)))
