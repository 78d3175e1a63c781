"""File and catalog sources: each query writes table rows out and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.text import explode_lines
from weftline.plans.registry import LINES_SQL, query
from weftline.session import scratch_path
from weftline.sources import files, tables
from weftline.sources.tables import table


@query("scan_text_lines", f"SELECT line AS value FROM ({LINES_SQL})")
def scan_text_lines(spark, d):
    path = scratch_path(spark, "lines")
    explode_lines(table(spark, d, "documents"), "text", name="value").write.text(path)
    return files.read_lines(spark, path)


@query("scan_delimited", "SELECT c_name AS name, c_nationkey AS age FROM customer")
def scan_delimited(spark, d):
    """``name, age`` lines split at the comma, trimmed and cast."""
    path = scratch_path(spark, "people")
    people = table(spark, d, "customer").select(F.concat_ws(", ", "c_name", "c_nationkey").alias("value"))
    people.write.text(path)
    return files.parse_fields(files.read_lines(spark, path), ",", {"name": "string", "age": "int"})


@query("scan_string_schema", "SELECT c_name AS name, c_nationkey::VARCHAR AS age FROM customer")
def scan_string_schema(spark, d):
    path = scratch_path(spark, "people")
    table(spark, d, "customer").select("c_name", "c_nationkey").write.csv(path)
    return files.read_delimited(spark, path, files.string_schema("name age"))


@query(
    "json_props",
    """SELECT event_id, event_type, (props->>'k')::BIGINT AS k FROM events""",
)
def json_props(spark, d):
    """Event properties written as JSON lines and read with a declared schema."""
    path = scratch_path(spark, "props")
    events = table(spark, d, "events")
    props = F.from_json("props", "k bigint")
    events.select("event_id", "event_type", props.getField("k").alias("k")).write.json(path)
    return files.read_json_lines(spark, path, "event_id bigint, event_type string, k bigint")


@query(
    "parquet_merge_schema",
    """SELECT p_partkey AS value, p_partkey * p_partkey AS square, NULL::BIGINT AS cube, 1 AS key
       FROM part WHERE p_size <= 25
       UNION ALL
       SELECT p_partkey, NULL, p_partkey * p_partkey * p_partkey, 2 FROM part WHERE p_size > 25""",
)
def parquet_merge_schema(spark, d):
    path = scratch_path(spark, "merge")
    part = table(spark, d, "part")
    files.write_key_folders(
        {
            1: part.filter("p_size <= 25").selectExpr("p_partkey AS value", "p_partkey * p_partkey AS square"),
            2: part.filter("p_size > 25").selectExpr("p_partkey AS value", "p_partkey * p_partkey * p_partkey AS cube"),
        },
        path,
    )
    return files.read_merged(spark, path).select("value", "square", "cube", "key")


@query(
    "range_squares",
    """SELECT i AS value, i * i AS square, count(o_orderkey) AS n_orders
       FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) t(i) LEFT JOIN orders ON o_orderkey = i GROUP BY i""",
)
def range_squares(spark, d):
    """A generated range as long as the order keys, met by the orders that have them; only its bound reaches the driver."""
    keys = table(spark, d, "orders").select(F.col("o_orderkey").alias("value"))
    top = keys.agg(F.max("value")).first()[0]
    numbers = spark.range(top + 1).select(F.col("id").alias("value"), (F.col("id") * F.col("id")).alias("square"))
    return numbers.join(keys.groupBy("value").agg(F.count("*").alias("n_orders")), "value", "left").fillna(0, ["n_orders"])


@query("managed_table_roundtrip", "SELECT c_custkey AS key, c_name AS value FROM customer")
def managed_table_roundtrip(spark, d):
    """Create a table, fill it, overwrite it from a frame and read it."""
    name = f"{tables.scratch_database(spark)}.records"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (key BIGINT, value STRING) USING parquet")
    pairs = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("value"))
    return tables.save_managed(pairs, name)


@query("load_file_into_table", "SELECT c_custkey AS key, c_name AS value FROM customer")
def load_file_into_table(spark, d):
    path = scratch_path(spark, "kv")
    table(spark, d, "customer").select("c_custkey", "c_name").write.csv(path, sep="\x01")
    name = f"{tables.scratch_database(spark)}.src"
    return tables.load_delimited(spark, name, "key BIGINT, value STRING", path)


@query("external_table", "SELECT c_custkey AS key FROM customer")
def external_table(spark, d):
    path = scratch_path(spark, "ints")
    table(spark, d, "customer").select(F.col("c_custkey").alias("key")).write.parquet(path)
    name = f"{tables.scratch_database(spark)}.ints"
    return tables.create_external(spark, name, "key BIGINT", path)


@query(
    "dynamic_partition_write",
    "SELECT c_custkey AS id, c_name AS value, c_nationkey AS key FROM customer",
)
def dynamic_partition_write(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("id"), F.col("c_name").alias("value")
    )
    return tables.save_partitioned(rows, f"{tables.scratch_database(spark)}.part_tbl", "key")


@query(
    "edge_list_scan",
    """SELECT l_suppkey AS src, l_partkey AS dst, 1 AS attr FROM lineitem""",
)
def edge_list_scan(spark, d):
    path = scratch_path(spark, "edges")
    table(spark, d, "lineitem").select(F.concat_ws(" ", "l_suppkey", "l_partkey").alias("value")).write.text(path)
    return files.read_edge_list(spark, path)
