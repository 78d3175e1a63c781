"""Cell tables in regions: which files and row groups a lookup reads."""

import uuid

import pytest
from pyspark.sql import functions as F

from weftline.operators import cells as C
from weftline.session import scratch_path
from weftline.sources import region_cells as R


def made(spark, n=20_000, regions=8):
    rows = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("key"), F.concat(F.lit("name "), "id").alias("name"), (F.col("id") % 7).cast("string").alias("kind"))
    cells = C.to_cells(rows, version=1)
    path = scratch_path(spark, "regions")
    R.create_regions(spark, path, R.even_splits(cells, regions))
    R.load_regions(cells, path, keys_per_file=n // regions)
    return path


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("row_key"))


def scans(df):
    """Files and rows that the scans of a finished query have read."""
    def leaves(plan):
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return leaves(plan.executedPlan())
        found = plan.collectLeaves()
        return [found.apply(i) for i in range(found.size())]

    metrics = [leaf.metrics() for leaf in leaves(df._jdf.queryExecution().executedPlan())]
    return [(m.apply("numFiles").value(), m.apply("numOutputRows").value()) for m in metrics if m.contains("numFiles")]


def test_three_far_keys_read_three_regions_and_few_rows(spark):
    path = made(spark)
    found = R.cells_of_keys(spark, path, keys(spark, 5, 11_111, 19_999, 5, None))
    got = sorted((bytes(r["qualifier"].encode()), bytes(r["value"])) for r in found.collect())
    assert got == sorted((q, v) for i in (5, 11_111, 19_999) for q, v in ((b"name", f"name {i}".encode()), (b"kind", str(i % 7).encode())))
    (files, read), = scans(found)
    every = R.read_regions(spark, path)
    n_files, n_regions = len(every.inputFiles()), every.select("region").distinct().count()
    assert n_regions == 8 and files <= 3 * -(-n_files // n_regions) + 3 and read < 0.5 * every.count()


def test_bloom_filters_skip_a_key_that_is_in_range_but_absent(spark):
    path = made(spark)
    found = R.cells_of_keys(spark, path, keys(spark, 1_000_000))
    assert found.collect() == []
    (files, read), = scans(found)
    assert files >= 1 and read == 0


def test_many_keys_are_joined_with_the_same_result(spark):
    path = made(spark)
    wanted = keys(spark, *range(0, 20_000, 40), 999_999)
    got = [sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in R.cells_of_keys(spark, path, wanted, named).collect()) for named in (0, 1000)]
    assert got[0] == got[1] and len(got[0]) == 1000


def test_loads_share_the_regions_and_newer_versions_win(spark):
    path = made(spark, 100, 4)
    newer = spark.range(3).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.lit("new").alias("name"))
    R.load_regions(C.to_cells(newer, version=2), path)
    columns = C.declare_columns([("key", "string"), ("name", "string"), ("kind", "string")], [":key", "info:name", "info:kind"])
    names = spark.range(2, 5).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    got = C.typed_scan(None, columns, keys=names, of_keys=lambda k: R.cells_of_keys(spark, path, k))
    assert sorted((r["name"], r["kind"]) for r in got.collect()) == [("name 3", "3"), ("name 4", "4"), ("new", "2")]


def test_splits_of_few_and_equal_keys(spark):
    same = C.to_cells(spark.createDataFrame([("a", str(i)) for i in range(50)], "key string, v string"), version=1)
    assert R.even_splits(same, 4) in ([], [b"a"])
    path = scratch_path(spark, f"regions-{uuid.uuid4().hex}")
    R.create_regions(spark, path, [])
    R.load_regions(same, path)
    assert R.cells_of_keys(spark, path, spark.createDataFrame([(bytearray(b"a"),)], "row_key binary")).count() == 50
    assert R.cells_of_keys(spark, path, spark.createDataFrame([], "row_key binary")).count() == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        R.create_regions(spark, path, [b"b"])
