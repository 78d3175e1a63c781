import math

import pytest
from pyspark.sql import functions as F

from weftline.functions.aggregates import average_or_nan, register_average, register_column_average, sum_count_average
from weftline.operators import relational as R
from weftline.session import scratch_path
from weftline.sources import files, jdbc, tables, topics


def test_averages(spark):
    pay = spark.createDataFrame([("a", 3000), ("b", 4500), ("c", 3500), ("d", 4000), ("e", None)], "name string, salary bigint")
    salary = F.col("salary")
    assert tuple(pay.agg(average_or_nan(salary), sum_count_average(salary)).first()) == (3750.0, 3750.0)
    none = pay.filter("salary IS NULL").agg(average_or_nan(salary), sum_count_average(salary)).first()
    assert all(math.isnan(v) for v in none)
    register_average(spark, "test_average")
    pay.repartition(3).groupBy("name").agg(
        F.coalesce(F.sum("salary"), F.lit(0)).cast("double").alias("total"), F.count("salary").alias("n")
    ).createOrReplaceTempView("pay_sums")
    assert spark.sql("SELECT test_average(total, n) FROM pay_sums").first()[0] == 3750.0
    assert math.isnan(spark.sql("SELECT test_average(total, n) FROM pay_sums WHERE n = 0").first()[0])


def test_catalog_lines(spark, rows):
    lines = ["1\tAnn ", "no tab", "x\tBad id", "2\t", "3\ttab\tinside", "", "\tempty id", " 4\tblank", "99999999999\tbig", "-5\tneg"]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert rows(R.parse_catalog(df)) == [(-5, "neg"), (1, "Ann"), (2, ""), (3, "tab\tinside")]


def test_alias_lines_and_last_wins(spark, rows):
    lines = [(0, "1\t10"), (1, "\t5"), (2, "1\t11"), (3, "7\tx"), (4, "2\t20")]
    df = spark.createDataFrame(lines, "at int, value string")
    pairs = R.parse_alias(df)
    assert rows(pairs) == [(1, 10), (1, 11), (2, 20)]
    ordered = spark.createDataFrame([(1, 10, 0), (1, 11, 2), (2, 20, 4)], "bad int, good int, at int")
    alias = R.last_per_key(ordered, "bad", "good", "at")
    plays = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "item int, who string")
    assert rows(R.canonical_ids(plays, "item", alias)) == [(11, "a"), (20, "b"), (3, "c")]


def test_lookup_is_broadcast_only_when_small(spark):
    big = spark.range(1000).withColumnRenamed("id", "bad").withColumn("good", F.col("bad"))
    assert "broadcast" in R.broadcast_if_small(big, 1000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in R.broadcast_if_small(big, 999)._jdf.queryExecution().logical().toString().lower()


def test_counts_and_statistics(spark):
    df = spark.createDataFrame([("ab",), ("a",), ("c",)], "value string")
    assert tuple(R.count_containing(df, "value", "a", "b").first()) == (2, 1)
    stats = R.column_statistics(spark.range(1, 6), "id").first()
    assert (stats.field, stats.n, stats.mean, stats.max, stats.min) == ("id", 5, 3.0, 5.0, 1.0)
    assert stats.stdev == pytest.approx(math.sqrt(2))


def test_block_list(spark, rows):
    df = spark.createDataFrame([("val", 2), ("ok", 1), (None, 4)], "word string, n int")
    listed = spark.createDataFrame([("val",), ("def",)], "word string")
    assert {r[1] for r in rows(R.drop_listed(df, listed, "word"))} == {1, 4}


def test_text_sources(spark, rows):
    path = scratch_path(spark, "people")
    spark.createDataFrame([("Ann, 29",), ("Bob,  30 ",)], "value string").write.text(path)
    people = files.parse_fields(files.read_lines(spark, path, 2), ",", {"name": "string", "age": "int"})
    assert rows(people) == [("Ann", 29), ("Bob", 30)]
    assert files.string_schema("name age").simpleString() == "struct<name:string,age:string>"


def test_lines_with_carriage_returns_stay_whole(spark):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("a\rb",), ("c",)], "value string").write.text(path)
    assert sorted(r[0] for r in files.read_lines(spark, path).collect()) == ["a\rb", "c"]


def test_merged_folders(spark, rows):
    path = scratch_path(spark, "merge")
    squares = spark.range(1, 6).selectExpr("int(id) AS value", "int(id * id) AS square")
    cubes = spark.range(6, 11).selectExpr("int(id) AS value", "int(id * id * id) AS cube")
    files.write_key_folders({1: squares, 2: cubes}, path)
    merged = files.read_merged(spark, path)
    assert sorted(merged.dtypes) == [("cube", "int"), ("key", "int"), ("square", "int"), ("value", "int")]
    assert merged.count() == 10
    assert rows(merged.filter("value IN (5, 6)"), "value", "square", "cube", "key") == [(5, 25, None, 1), (6, None, 216, 2)]


def test_edge_list(spark, rows):
    path = scratch_path(spark, "edges")
    spark.createDataFrame([("# comment",), ("2 1",), ("4\t1",), ("  1   2 ",)], "value string").write.text(path)
    assert rows(files.read_edge_list(spark, path)) == [(1, 2, 1), (2, 1, 1), (4, 1, 1)]


def test_catalog_tables(spark, rows):
    base = tables.scratch_database(spark)
    pairs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "key int, value string")
    tables.save_managed(pairs, f"{base}.t")
    assert rows(tables.save_managed(pairs.filter("key = 1"), f"{base}.t")) == [(1, "a")]
    parted = tables.save_partitioned(pairs, f"{base}.p", "key")
    assert parted.columns == ["value", "key"] and parted.count() == 3
    path = scratch_path(spark, "kv")
    pairs.write.csv(path, sep="\x01")
    tables.load_delimited(spark, f"{base}.l", "key INT, value STRING", path)
    assert tables.load_delimited(spark, f"{base}.l", "key INT, value STRING", path).count() == 6


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:x:y", "book", user="u", password="p")
    assert options == {"url": "jdbc:x:y", "dbtable": "book", "user": "u", "password": "p"}
    with pytest.raises(ValueError):
        jdbc.read_jdbc(None, "jdbc:x:y", "book", split_column="id")


def test_topics(spark, rows):
    records = spark.createDataFrame([("a", b"x y"), ("b", b"z"), ("c", b"no")], "topic string, value binary")
    assert rows(topics.decode_topic(records, ["a", "b"])) == [("a", "x y"), ("b", "z")]


def test_average_of_a_plain_column_with_a_hot_group(spark):
    """One group has nearly all of two million rows; others have a null only, or nothing that counts."""
    register_column_average(spark, "test_average_of")
    data = spark.range(2_000_000).selectExpr("CASE WHEN id < 1999990 THEN 'hot' ELSE concat('k', id % 3) END AS k", "CASE WHEN id >= 1999990 AND id % 3 = 1 THEN NULL ELSE id END AS x")
    data.createOrReplaceTempView("hot_rows")
    got = {r[0]: r[1] for r in spark.sql("SELECT k, test_average_of(x) FROM hot_rows GROUP BY k").collect()}
    assert got["hot"] == (1_999_990 - 1) / 2 and math.isnan(got["k1"]) and got["k0"] > 1_999_990
    assert math.isnan(spark.sql("SELECT test_average_of(x) FROM hot_rows WHERE x IS NULL").first()[0])
    assert spark.sql("SELECT k, test_average_of(x) FROM hot_rows WHERE x < 0 GROUP BY k").collect() == []
