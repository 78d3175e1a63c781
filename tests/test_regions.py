import pytest
from pyspark.sql import functions as F

from weftline.operators import regions as G
from weftline.session import scratch_path


def test_decimal_splits():
    assert G.decimal_splits(10, "00") == [f"{d}9|" for d in range(9)]
    assert G.decimal_splits(3, "00") == ["32|", "65|"]
    assert G.decimal_splits(4, "00", "0", "49") == ["11|", "23|", "36|"]
    assert len(G.decimal_splits(500, "0")) == 9
    with pytest.raises(ValueError):
        G.decimal_splits(4, "00", "50", "10")


def test_decimal_splits_are_even():
    for regions in range(2, 60):
        points = [-1, *[int(p[:-1]) for p in G.decimal_splits(regions, "00")], 99]
        sizes = [b - a for a, b in zip(points, points[1:])]
        assert sizes == sorted(sizes) and max(sizes) - min(sizes) <= 1 and sum(sizes) == 100


def test_hex_splits():
    assert G.hex_splits(4) == ["3" + "f" * 31, "7" + "f" * 30 + "e", "b" + "f" * 30 + "d"]
    assert G.hex_splits(2, "00", "10") == ["0" * 31 + "8"]


def test_precedence():
    assert G.choose_splits('["a","b","z"]', "00", 4) == ["a", "b"]
    assert G.choose_splits(None, "00", 3) == ["32|", "65|"]
    assert G.choose_splits(None, None, 2) == ["7" + "f" * 31]
    assert G.choose_splits() == []


def test_region_includes_its_split_point(spark):
    df = spark.createDataFrame([("a",), ("b",), ("bz",), ("c",), ("é",)], "k string")
    got = [r[0] for r in df.select(G.region_of(F.col("k"), ["c", "b"])).collect()]
    assert got == [0, 1, 1, 2, 2]


def test_written_regions_hold_their_rows(spark, rows):
    path = scratch_path(spark, "regions")
    df = spark.range(300).selectExpr("lpad(id % 100, 2, '0') AS k", "id")
    G.write_regions(df, "k", ["32|", "65|"], path)
    stored = spark.read.schema("k string, id bigint, region int").parquet(path)
    assert stored.count() == 300
    got = rows(stored.groupBy("region").agg(F.min("k"), F.max("k")))
    assert got == [(0, "00", "32"), (1, "33", "65"), (2, "66", "99")]


def test_hot_region_is_written_by_several_tasks(spark):
    """Also when the region is one key with equal rows."""
    path = scratch_path(spark, "regions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, 'z', lpad(id % 100, 2, '0')) AS k", "'same' AS v")
        G.write_regions(df, "k", ["50", "y"], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.schema("k string, v string, region int").parquet(path)
    assert stored.count() == 60000
    assert stored.filter("region = 2").select(F.input_file_name()).distinct().count() > 1
