"""Cell-table and region queries over ``customer`` and ``supplier``."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.codec import decode_cell, encode_cell
from weftline.operators import cells as C
from weftline.operators import regions as G
from weftline.plans.registry import query
from weftline.session import scratch_path
from weftline.sources import cells as S
from weftline.sources import region_cells as R
from weftline.sources.tables import table

CUSTOMER_FIELDS = [
    ("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "int"),
    ("c_acctbal", "double"), ("c_mktsegment", "string"),
]
CUSTOMER_CELLS = [":rowkey", "info:c_name", "info:c_nationkey", "info:c_acctbal", "info:c_mktsegment"]
CUSTOMER_COLUMNS = C.declare_columns(CUSTOMER_FIELDS, CUSTOMER_CELLS)


def customer_cells(spark, d, version=1):
    return C.to_cells(table(spark, d, "customer"), "c_custkey", version=version)


def stored(spark, cells, load=S.append_cells):
    """The cells as a table that was written and is read back."""
    path = scratch_path(spark, "cells")
    load(cells, path)
    return S.read_cells(spark, path)


@query("cells_typed_scan", "SELECT * FROM customer")
def cells_typed_scan(spark, d):
    path = scratch_path(spark, "cells")
    S.append_cells(customer_cells(spark, d), path)
    return C.typed_scan(S.read_cells(spark, path), CUSTOMER_COLUMNS)


@query(
    "cells_column_scan",
    "SELECT c_custkey, c_name, c_acctbal FROM customer",
)
def cells_column_scan(spark, d):
    wanted = [c for c in CUSTOMER_COLUMNS if c.field in ("c_custkey", "c_name", "c_acctbal")]
    return C.typed_scan(stored(spark, customer_cells(spark, d)), wanted)


@query(
    "cells_json_scan",
    """SELECT c_name AS rowkey,
              '{"info:c_mktsegment":"' || c_mktsegment || '","info:nation":"' || c_nationkey || '"}' AS content
       FROM customer""",
)
def cells_json_scan(spark, d):
    rows = table(spark, d, "customer").select(
        "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation")
    )
    return C.json_scan(stored(spark, C.to_cells(rows, version=1)))


@query(
    "cells_json_typed",
    """SELECT c_name AS rowkey,
              '{"info:big":' || (c_nationkey > 12) || ',"info:c_custkey":' || c_custkey ||
              ',"info:c_mktsegment":"' || c_mktsegment || '","info:c_nationkey":' || c_nationkey || '}' AS content
       FROM customer""",
)
def cells_json_typed(spark, d):
    rows = table(spark, d, "customer").select(
        "c_name", "c_mktsegment", "c_custkey", "c_nationkey", F.expr("c_nationkey > 12").alias("big")
    )
    hints = {"info:c_custkey": "LongType", "info:c_nationkey": "IntegerType", "info:big": "BooleanType"}
    return C.json_scan(stored(spark, C.to_cells(rows, version=1)), hints)


@query(
    "cells_codec",
    """SELECT o_orderkey, printf('%016X', o_orderkey) AS key_hex, printf('%016X', epoch_ms(o_orderdate)) AS date_hex,
              -1 - o_orderkey AS negative, o_totalprice AS price, o_orderstatus AS status,
              (o_custkey - 500)::INTEGER AS small, o_custkey > 500 AS flag,
              epoch_ms(o_orderdate) AS date_ms, o_totalprice::FLOAT::DOUBLE AS price_float, o_custkey % 7 = 0 AS not_a_number
       FROM orders""",
)
def cells_codec(spark, d):
    """Every type through its bytes and back, for all orders."""
    def through(column, kind):
        return decode_cell(encode_cell(column, kind), kind)

    orders = table(spark, d, "orders")
    when = F.col("o_orderdate").cast("timestamp")
    return orders.select(
        through(F.col("o_orderkey"), "bigint").alias("o_orderkey"),
        F.hex(encode_cell(F.col("o_orderkey"), "bigint")).alias("key_hex"),
        F.hex(encode_cell(when, "timestamp")).alias("date_hex"),
        through(-1 - F.col("o_orderkey"), "bigint").alias("negative"),
        through(F.col("o_totalprice"), "double").alias("price"),
        through(F.col("o_orderstatus"), "string").alias("status"),
        through((F.col("o_custkey") - 500).cast("int"), "int").alias("small"),
        through(F.col("o_custkey") > 500, "boolean").alias("flag"),
        F.unix_millis(through(when, "timestamp")).alias("date_ms"),
        through(F.col("o_totalprice").cast("float"), "float").cast("double").alias("price_float"),
        F.isnan(through(F.when(F.col("o_custkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")), "double")).alias("not_a_number"),
    )


@query(
    "cells_unpivot",
    """SELECT c_name AS row_key, 'info' AS family, unnest(['c_mktsegment', 'nation']) AS qualifier,
              unnest([c_mktsegment, c_nationkey::VARCHAR]) AS value FROM customer""",
)
def cells_unpivot(spark, d):
    rows = table(spark, d, "customer").select(
        "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("nation")
    )
    cells = C.to_cells(rows, version=1)
    return cells.select(
        F.col("row_key").cast("string").alias("row_key"), "family", "qualifier",
        F.col("value").cast("string").alias("value"),
    )


@query(
    "cells_upsert",
    """SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def cells_upsert(spark, d):
    """A second load replaces two cells of the customers in debt, then the table is compacted."""
    path, compacted = scratch_path(spark, "cells"), scratch_path(spark, "cells")
    S.append_cells(customer_cells(spark, d, version=1), path)
    debt = table(spark, d, "customer").filter("c_acctbal < 0").select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit("REVIEW").alias("c_mktsegment")
    )
    S.append_cells(C.to_cells(debt, version=2), path)
    S.compact(spark, path, compacted)
    return C.typed_scan(S.read_cells(spark, compacted), CUSTOMER_COLUMNS)


@query("cells_bulk_load", "SELECT * FROM customer")
def cells_bulk_load(spark, d):
    path = scratch_path(spark, "cells")
    S.bulk_load(customer_cells(spark, d), path)
    return C.typed_scan(S.read_cells(spark, path), CUSTOMER_COLUMNS)


@query(
    "cells_key_lookup",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000""",
)
def cells_key_lookup(spark, d):
    """Customer rows of large orders: one row per order, none for unknown keys."""
    keys = table(spark, d, "orders").filter("o_totalprice > 300000").select("o_custkey")
    return C.typed_scan(stored(spark, customer_cells(spark, d), S.bulk_load), CUSTOMER_COLUMNS, keys=keys)


def in_regions(spark, cells, regions=16):
    """The cells as a table in regions; its path."""
    path = scratch_path(spark, "regions")
    R.create_regions(spark, path, R.even_splits(cells, regions))
    R.load_regions(cells, path)
    return path


@query(
    "cells_point_lookup",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
       WHERE c_custkey IN (SELECT min(o_custkey) FROM orders UNION ALL SELECT max(o_custkey) FROM orders
                           UNION ALL SELECT arg_max(o_custkey, (o_totalprice, o_orderkey)) FROM orders)""",
)
def cells_point_lookup(spark, d):
    """Three rows far apart: the first, the last and the best customer that ordered."""
    path = in_regions(spark, customer_cells(spark, d))
    best = F.max_by("o_custkey", F.struct("o_totalprice", "o_orderkey"))
    ends = table(spark, d, "orders").agg(F.array(F.min("o_custkey"), F.max("o_custkey"), best).alias("k"))
    keys = ends.select(F.explode(F.array_distinct("k")).alias("c_custkey"))
    return C.typed_scan(None, CUSTOMER_COLUMNS, keys=keys, of_keys=lambda k: R.cells_of_keys(spark, path, k))


@query(
    "cells_region_lookup",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice < 20000""",
)
def cells_region_lookup(spark, d):
    """Customer rows of all small orders, too many keys to name: joined on region and key, one row per order."""
    path = in_regions(spark, customer_cells(spark, d))
    keys = table(spark, d, "orders").filter("o_totalprice < 20000").select("o_custkey")
    return C.typed_scan(None, CUSTOMER_COLUMNS, keys=keys, of_keys=lambda k: R.cells_of_keys(spark, path, k, named=0))


@query(
    "cells_copy",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def cells_copy(spark, d):
    """Three named cells of every row go to a second table."""
    path = scratch_path(spark, "cells")
    three = [("info", "c_name"), ("info", "c_acctbal"), ("info", "c_mktsegment")]
    S.append_cells(C.only_cells(customer_cells(spark, d), three), path)
    wanted = [c for c in CUSTOMER_COLUMNS if c.is_row_key or (c.family, c.qualifier) in three]
    return C.typed_scan(S.read_cells(spark, path), wanted)


@query("cells_row_count", "SELECT count(*) AS n_rows, 4 * count(*) AS n_cells FROM customer")
def cells_row_count(spark, d):
    return C.row_count(stored(spark, customer_cells(spark, d)))


@query(
    "cells_render",
    "SELECT 'row ' || c_custkey || ': ' || c_name || ', ' || c_mktsegment AS line FROM customer",
)
def cells_render(spark, d):
    wanted = [c for c in CUSTOMER_COLUMNS if c.field in ("c_custkey", "c_name", "c_mktsegment")]
    rows = C.typed_scan(stored(spark, customer_cells(spark, d)), wanted)
    return rows.select(F.format_string("row %s: %s, %s", "c_custkey", "c_name", "c_mktsegment").alias("line"))


def region_report(df, key, splits):
    """Rows and key range of each region."""
    return (
        df.groupBy(G.region_of(F.col(key), splits).alias("region"))
        .agg(F.count("*").alias("n_rows"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    )


def region_sql(key_sql, splits, source="customer"):
    points = ", ".join(f"'{s}'" for s in splits)
    return f"""WITH k AS (SELECT {key_sql} AS key FROM {source})
        SELECT len(list_filter([{points}], lambda p: p <= key))::INTEGER AS region, count(*) AS n_rows,
               min(key) AS first_key, max(key) AS last_key FROM k GROUP BY 1"""


SEGMENT_SPLITS = '["B", "H", "M", "~"]'
SEGMENT_KEY = "c_mktsegment || '-' || c_name"
DECIMAL_KEY = "reverse(lpad(c_custkey::VARCHAR, 9, '0'))"


@query("region_rows_json", region_sql(SEGMENT_KEY, ["B", "H", "M"]))
def region_rows_json(spark, d):
    keyed = table(spark, d, "customer").select(F.concat_ws("-", "c_mktsegment", "c_name").alias("key"))
    return region_report(keyed, "key", G.splits_from_json(SEGMENT_SPLITS))


@query(
    "region_rows_hex",
    region_sql("md5(c_name)", [
        "1fffffffffffffffffffffffffffffff", "3ffffffffffffffffffffffffffffffe",
        "5ffffffffffffffffffffffffffffffd", "7ffffffffffffffffffffffffffffffc",
        "9ffffffffffffffffffffffffffffffb", "bffffffffffffffffffffffffffffffa",
        "dffffffffffffffffffffffffffffff9",
    ]),
)
def region_rows_hex(spark, d):
    keyed = table(spark, d, "customer").select(F.md5("c_name").alias("key"))
    return region_report(keyed, "key", G.hex_splits(8))


@query("region_rows_decimal", region_sql(DECIMAL_KEY, ["09|", "19|", "29|", "39|", "49|", "59|", "69|", "79|", "89|"]))
def region_rows_decimal(spark, d):
    keyed = table(spark, d, "customer").select(
        F.reverse(F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("key")
    )
    return region_report(keyed, "key", G.decimal_splits(10, "00"))


@query("cells_region_rows", region_sql(DECIMAL_KEY, ["32|", "65|"]))
def cells_region_rows(spark, d):
    """Rows written into region folders, read back and reported per folder."""
    splits = G.choose_splits(prefix="00", regions=3)
    path = scratch_path(spark, "regions")
    keyed = table(spark, d, "customer").select(
        F.reverse(F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("key"), "c_name"
    )
    G.write_regions(keyed, "key", splits, path)
    stored = spark.read.schema("key string, c_name string, region int").parquet(path)
    return stored.groupBy("region").agg(
        F.count("*").alias("n_rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key")
    )
