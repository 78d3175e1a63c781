import datetime as dt
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftline.functions.codec import decode_cell, encode_cell, hint_type, spark_type
from weftline.operators import cells as C
from weftline.sources import cells as S
from weftline.session import scratch_path

LONGS = [0, 1, 5, -2, 2**63 - 1, -(2**63)]


def hexed(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(F.hex(encode_cell(F.col("v"), kind))).collect()]


def test_encoding_is_big_endian(spark):
    assert hexed(spark, [-2, 5], "bigint") == ["FFFFFFFFFFFFFFFE", "0000000000000005"]
    assert hexed(spark, [1.5, -2.25], "double") == ["3FF8000000000000", "C002000000000000"]
    assert hexed(spark, [1.5], "float") == ["3FC00000"]
    assert hexed(spark, [-1, 258], "int") == ["FFFFFFFF", "00000102"]
    assert hexed(spark, [True, False], "boolean") == ["FF", "00"]
    assert hexed(spark, ["é", None], "string") == ["C3A9", ""]


@pytest.mark.parametrize(
    "kind, values",
    [
        ("bigint", LONGS),
        ("int", [0, -1, 2**31 - 1, -(2**31)]),
        ("double", [0.0, 1.5, -1e300, float("inf")]),
        ("float", [0.0, 0.25, -3.5]),
        ("boolean", [True, False]),
        ("string", ["", "x", "äöü"]),
        ("binary", [b"", b"\x00\xff"]),
        ("date", [dt.date(1969, 12, 31), dt.date(2024, 2, 29)]),
    ],
)
def test_round_trip(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    back = [r[0] for r in df.select(decode_cell(encode_cell(F.col("v"), kind), kind)).collect()]
    assert [bytes(b) if kind == "binary" else b for b in back] == values


def test_timestamps_keep_milliseconds(spark):
    df = spark.sql("SELECT timestamp'2024-01-02 03:04:05.678901' AS v")
    back = df.select(F.unix_micros(decode_cell(encode_cell(F.col("v"), "timestamp"), "timestamp"))).first()[0]
    assert back % 1_000_000 == 678_000


def test_nulls_and_bad_widths(spark):
    df = spark.createDataFrame([(None,), (b"\x01",), (b"\x00" * 8,)], "v binary")
    got = df.select(
        decode_cell(F.col("v"), "bigint"), decode_cell(F.col("v"), "bigint", missing_long_as_zero=False),
        decode_cell(F.col("v"), "double"), decode_cell(F.col("v"), "int"),
    ).collect()
    assert [tuple(r) for r in got] == [(0, None, None, None), (0, None, None, None), (0, 0, 0.0, None)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(width=64), min_size=1, max_size=30))
def test_double_bytes_match_struct(spark, values):
    assert hexed(spark, values, "double") == [struct.pack(">d", v).hex().upper() for v in values]


def test_nan_is_a_value_and_null_is_none(spark):
    df = spark.sql("SELECT * FROM VALUES (1, double('NaN')), (2, NULL), (3, -0.0D), (4, double('-Infinity')) AS t(id, v)")
    for kind in ("double", "float"):
        got = df.select("id", decode_cell(encode_cell(F.col("v").cast(kind), kind), kind).alias("v")).orderBy("id").collect()
        assert got[0].v != got[0].v and got[1].v is None and str(got[2].v) == "-0.0" and got[3].v == float("-inf")
    assert C.to_cells(df, version=1).count() == 3


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([("a", "x"), (None, "y")], "id string, v string")
    with pytest.raises(Exception, match="row key must not be null"):
        C.to_cells(df, version=1).collect()
    cells = C.to_cells(df.filter("id IS NOT NULL"), version=1)
    with pytest.raises(Exception, match="row key must not be null"):
        C.typed_scan(cells, C.declare_columns([("id", "string"), ("v", "string")], [":k", "info:v"]), keys=df.select("id")).collect()


@pytest.mark.parametrize("int_encoding", ["binary", "text"])
def test_keys_are_looked_up_as_the_table_has_them(spark, rows, int_encoding):
    df = spark.createDataFrame([(1, 5), (2, 6), (-3, 7)], "id int, v int")
    cells = C.to_cells(df, version=1, int_encoding=int_encoding)
    columns = C.declare_columns([("id", "int"), ("v", "int")], [":k", "info:v"])
    for kind in ("int", "bigint", "string"):
        keys = spark.createDataFrame([(2,), (-3,)], "k int").select(F.col("k").cast(kind))
        assert rows(C.typed_scan(cells, columns, keys, int_encoding)) == [(-3, 7), (2, 6)]
    longs = C.to_cells(df.select(F.col("id").cast("bigint").alias("id"), "v"), version=1)
    wide = C.declare_columns([("id", "long"), ("v", "int")], [":k", "info:v"])
    assert rows(C.typed_scan(longs, wide, spark.createDataFrame([(2,)], "k int"))) == [(2, 6)]


def test_the_range_of_the_keys_reaches_the_files(spark):
    path = scratch_path(spark, "cells")
    S.bulk_load(C.to_cells(spark.range(2000).selectExpr("lpad(id, 6, '0') AS id", "'v' AS a"), version=1), path, 4)
    columns = C.declare_columns([("id", "string"), ("a", "string")], [":k", "info:a"])
    keys = spark.createDataFrame([("000003",), ("000007",)], "k string")
    found = C.typed_scan(S.read_cells(spark, path), columns, keys)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(row_key" in plan and "LessThanOrEqual(row_key" in plan
    assert found.count() == 2
    assert C.typed_scan(S.read_cells(spark, path), columns, keys.limit(0)).count() == 0


def test_type_names():
    assert [spark_type(n) for n in ("Long", "INT", "integer", "datetype", "date", "decimal", "String")] == [
        "bigint", "int", "int", "date", "string", "string", "string"]
    assert hint_type("DoubleType") == "double" and hint_type("other") == "string"


def test_declared_columns_must_pair_up():
    with pytest.raises(ValueError):
        C.declare_columns([("id", "string")], [])
    with pytest.raises(ValueError):
        C.declare_columns([("id", "string"), ("n", "int")], [":rowkey"])


def book(spark, rows, version):
    df = spark.createDataFrame(rows, "id string, name string, age int, sex string")
    return C.to_cells(df, version=version)


COLUMNS = C.declare_columns(
    [("id", "String"), ("name", "String"), ("age", "Int"), ("sex", "String")],
    [":rowkey", "info:name", "info:age", "info:sex"],
)


def test_upsert_latest_version_wins_and_other_cells_stay(spark, rows):
    path = scratch_path(spark, "cells")
    S.append_cells(book(spark, [("1", "ann", 20, "f"), ("2", "bob", 30, "m")], 1), path)
    newer = spark.createDataFrame([("1", 21)], "id string, age int")
    S.append_cells(C.to_cells(newer, version=2), path)
    older = spark.createDataFrame([("2", 99)], "id string, age int")
    S.append_cells(C.to_cells(older, version=0), path)
    want = [("1", "ann", 21, "f"), ("2", "bob", 30, "m")]
    assert rows(C.typed_scan(S.read_cells(spark, path), COLUMNS)) == want
    target = scratch_path(spark, "cells")
    S.compact(spark, path, target)
    compacted = S.read_cells(spark, target)
    assert rows(C.typed_scan(compacted, COLUMNS)) == want and compacted.count() == 6


def test_equal_versions_give_one_definite_value(spark, rows):
    cells = book(spark, [("1", "ann", 20, "f"), ("1", "zoe", 10, "f")], 1)
    assert rows(C.typed_scan(cells.repartition(3), COLUMNS)) == [("1", "zoe", 20, "f")]
    assert rows(C.latest(cells).filter("qualifier = 'name'"), "version") == [(1,)]


def test_null_string_is_empty_and_other_nulls_write_nothing(spark, rows):
    cells = book(spark, [("1", None, None, "f")], 1)
    assert cells.count() == 2
    assert rows(C.typed_scan(cells, COLUMNS)) == [("1", "", None, "f")]


def test_row_key_choice_and_checks(spark):
    df = spark.createDataFrame([(7, "a")], "n bigint, k string")
    assert C.to_cells(df, "k", version=1).first().row_key == b"a"
    assert C.to_cells(df, version=1).first().row_key == b"\0\0\0\0\0\0\0\x07"
    with pytest.raises(ValueError):
        C.to_cells(df, "missing")
    with pytest.raises(ValueError):
        S.read_cells(spark, "")


def test_text_integers(spark, rows):
    df = spark.createDataFrame([("1", 42)], "id string, age int")
    cells = C.to_cells(df, version=1, int_encoding="text")
    assert cells.first().value == b"42"
    columns = C.declare_columns([("age", "int")], ["info:age"])
    assert rows(C.typed_scan(cells, columns, int_encoding="text")) == [(42,)]


def test_rows_without_scanned_cells_vanish(spark, rows):
    cells = book(spark, [("1", "ann", None, "f"), ("2", "bob", 3, "m")], 1)
    columns = C.declare_columns([("id", "string"), ("age", "int")], [":rowkey", "info:age"])
    assert rows(C.typed_scan(cells, columns)) == [("2", 3)]
    only_key = C.declare_columns([("id", "string")], [":rowkey"])
    assert rows(C.typed_scan(cells, only_key)) == [("1",), ("2",)]


def test_key_lookup_repeats_duplicates_and_drops_unknown(spark, rows):
    cells = book(spark, [("1", "ann", 20, "f"), ("2", "bob", 30, "m")], 1)
    keys = spark.createDataFrame([("2",), ("2",), ("9",)], "k string")
    assert rows(C.typed_scan(cells, COLUMNS, keys=keys)) == [("2", "bob", 30, "m")] * 2
    assert [r[0] for r in rows(C.json_scan(cells, keys=keys))] == ["2", "2"]


def test_json_scan_sorts_members_and_escapes(spark, rows):
    df = spark.createDataFrame([("r", 'q"uote', "line\nbreak")], "id string, b string, a string")
    assert rows(C.json_scan(C.to_cells(df, version=1))) == [("r", '{"info:a":"line\\nbreak","info:b":"q\\"uote"}')]


def test_json_hints(spark):
    df = spark.sql(
        "SELECT 'r' AS id, 5L AS l, 1.5D AS d, cast(2.5 AS float) AS f, 3 AS i, true AS b, X'0102' AS x,"
        " timestamp'2024-01-02 03:04:05.678' AS t, date'2024-02-03' AS y, 'plain' AS s"
    )
    hints = {
        "info:l": "LongType", "info:d": "DoubleType", "info:f": "FloatType", "info:i": "IntegerType",
        "info:b": "BooleanType", "info:x": "BinaryType", "info:t": "TimestampType", "info:y": "DateType",
    }
    content = C.json_scan(C.to_cells(df, version=1), hints).first().content
    assert content == (
        '{"info:b":true,"info:d":1.5,"info:f":2.5,"info:i":3,"info:l":5,"info:s":"plain",'
        '"info:t":"2024-01-02T03:04:05.678","info:x":"AQI=","info:y":"2024-02-03"}'
    )


def test_bulk_load_writes_sorted_key_ranges(spark):
    path = scratch_path(spark, "cells")
    df = spark.range(2000).selectExpr("lpad(id, 6, '0') AS id", "'v' AS a", "'w' AS b")
    S.bulk_load(C.to_cells(df, version=1), path, 4)
    stored = spark.read.parquet(path).select("row_key", "qualifier", F.input_file_name().alias("file"))
    spans = sorted(
        (r.low, r.high) for r in stored.groupBy("file").agg(F.min("row_key").alias("low"), F.max("row_key").alias("high")).collect()
    )
    assert len(spans) > 1
    assert all(bytes(a[1]) <= bytes(b[0]) for a, b in zip(spans, spans[1:]))
    one = stored.filter(F.col("file") == stored.first().file)
    kept = [(bytes(r.row_key), r.qualifier) for r in one.collect()]
    assert kept == sorted(kept)


def test_family_and_qualifier_filters_reach_the_files(spark):
    path = scratch_path(spark, "cells")
    S.append_cells(book(spark, [("1", "ann", 20, "f")], 1), path)
    columns = C.declare_columns([("age", "int")], ["info:age"])
    plan = C.typed_scan(S.read_cells(spark, path), columns)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(family" in plan
    assert "EqualTo(qualifier,age)" in plan


def test_counts(spark):
    cells = book(spark, [("1", "ann", 20, "f"), ("2", "bob", 30, "m")], 1)
    again = cells.union(cells.withColumn("version", F.lit(5).cast("bigint")))
    assert tuple(C.row_count(again).first()) == (2, 6)
