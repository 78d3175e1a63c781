"""Pre-split key space: split points, region of a row, region-wise writes."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def splits_from_json(text: str) -> list[str]:
    """Split points of a JSON array; its last element only closes the list."""
    return [str(point) for point in json.loads(text)][:-1]


def hex_splits(regions: int, start: str | None = None, end: str | None = None) -> list[str]:
    """``regions - 1`` equally spaced keys of 32 hex digits."""
    low = int(start, 16) if start else 0
    high = int(end, 16) if end else 16**32 - 1
    step = (high - low) // regions
    return [f"{low + step * i:032x}" for i in range(1, regions)]


def decimal_splits(
    regions: int, prefix: str, start: str | None = None, end: str | None = None
) -> list[str]:
    """Zero-padded decimal keys ending in ``|``; region sizes differ by at most one.

    The smaller regions come first.  There are never more regions than keys of
    the prefix's width or than keys in the range.
    """
    digits = len(prefix.strip())
    low = int(start) if start else 0
    high = min(10**digits, int(end)) if end else 10**digits - 1
    if high <= low:
        raise ValueError("the start key must be smaller than the end key")
    keys = high - low + 1
    regions = min(regions, 10**digits, keys)
    size, larger = divmod(keys, regions)
    width = max(prefix.strip().count("0"), 1)
    points = [low - 1 + i * size + max(0, i - (regions - larger)) for i in range(1, regions)]
    return sorted(f"{point:0{width}d}|" for point in points)


def choose_splits(
    splits: str | None = None,
    prefix: str | None = None,
    regions: int = -1,
    start: str | None = None,
    end: str | None = None,
) -> list[str]:
    """An explicit list wins over a prefix, a prefix over a count, else one region."""
    if splits is not None:
        return splits_from_json(splits)
    if prefix is not None:
        return decimal_splits(regions, prefix, start, end)
    if regions != -1:
        return hex_splits(regions, start, end)
    return []


def region_of(key: Column, splits: list[str] | list[bytes]) -> Column:
    """Number of split points at or below a key; keys compare as bytes."""
    points = sorted(s.encode() if isinstance(s, str) else bytes(s) for s in splits)
    raw = key.cast("binary")

    def search(low: int, high: int) -> Column:
        # A balanced tree of comparisons: log2(n) of them per row, all in generated code.
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(raw < F.lit(points[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(points))


def write_regions(df: DataFrame, key: str, splits: list[str], path: str) -> None:
    """One folder per region, its files sorted by key.

    Rebalancing splits a region that is too large for one task by size, also
    when a single key makes up most of it.
    """
    placed = df.withColumn("region", region_of(F.col(key), splits))
    (
        placed.hint("rebalance", "region")
        .sortWithinPartitions("region", key)
        .write.partitionBy("region")
        .parquet(path)
    )
