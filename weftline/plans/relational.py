"""Projections, filters, joins, aggregates and orders over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.aggregates import average_or_nan, register_average, register_column_average, sum_count_average
from weftline.functions.text import explode_lines, words_of_text
from weftline.operators import relational as R
from weftline.plans.registry import LINES_SQL, TRIMMED_WORDS_SQL, WORDS_SQL, query
from weftline.sources.tables import listed, register_views, table, widened

# The words that are dropped from counts.
BLOCKED_WORDS = ["val", "var", "def"]


def documents(spark, d):
    return widened(table(spark, d, "documents").select("text"))


@query("word_count", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def word_count(spark, d):
    words = words_of_text(documents(spark, d), "text")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(
    "word_count_sorted",
    f"SELECT word, count(*) AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word ORDER BY word, n",
)
def word_count_sorted(spark, d):
    words = words_of_text(documents(spark, d), "text", trim=True)
    return words.groupBy("word").agg(F.count("*").alias("n")).orderBy("word", "n")


@query(
    "project_filter",
    """SELECT c_custkey, c_name, c_acctbal FROM customer
       WHERE c_acctbal > 1000 AND c_nationkey < 20""",
)
def project_filter(spark, d):
    return (
        table(spark, d, "customer")
        .filter("c_acctbal > 1000 AND c_nationkey < 20")
        .select("c_custkey", "c_name", "c_acctbal")
    )


@query("filter_between", "SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19")
def filter_between(spark, d):
    register_views(spark, d, "part")
    return spark.sql("SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 19")


@query("filter_hidden_column", "SELECT event_type FROM events WHERE value > 10")
def filter_hidden_column(spark, d):
    return table(spark, d, "events").select("event_type").where("value > 10")


@query(
    "count_lines_containing",
    f"""SELECT count(*) FILTER (WHERE contains(line, 'a')) AS n_a,
               count(*) FILTER (WHERE contains(line, 'b')) AS n_b FROM ({LINES_SQL})""",
)
def count_lines_containing(spark, d):
    lines = explode_lines(documents(spark, d), "text")
    return R.count_containing(lines, "line", "a", "b")


@query(
    "filter_equality",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def filter_equality(spark, d):
    return (
        table(spark, d, "orders")
        .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
        .select("o_orderkey", "o_custkey")
    )


@query(
    "semi_join_membership",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""",
)
def semi_join_membership(spark, d):
    big = table(spark, d, "orders").filter("o_totalprice > 400000")
    keys = big.select(F.col("o_custkey").alias("c_custkey"))
    return R.members(table(spark, d, "customer").select("c_custkey", "c_name"), keys, "c_custkey")


@query(
    "format_rows",
    """SELECT 'Key: ' || c_custkey || ', Value: ' || c_name AS by_name,
              'Name: ' || c_name AS by_index FROM customer""",
)
def format_rows(spark, d):
    return table(spark, d, "customer").select(
        F.format_string("Key: %s, Value: %s", "c_custkey", "c_name").alias("by_name"),
        F.concat(F.lit("Name: "), "c_name").alias("by_index"),
    )


@query(
    "row_to_map",
    """SELECT c_custkey, '{"name":"' || c_name || '","segment":"' || c_mktsegment || '"}' AS row_map
       FROM customer""",
)
def row_to_map(spark, d):
    pairs = F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", F.to_json(pairs).alias("row_map"))


@query(
    "parse_or_drop",
    r"""WITH raw AS (
          SELECT CASE WHEN p_size % 7 = 0 THEN p_name
                      WHEN p_size % 5 = 0 THEN 'x' || p_partkey || chr(9) || p_name
                      ELSE p_partkey || chr(9) || ' ' || p_name || chr(9) || p_brand || ' ' END AS value
          FROM part)
        SELECT TRY_CAST(string_split(value, chr(9))[1] AS INTEGER) AS id,
               trim(substr(value, position(chr(9) IN value)), ' ' || chr(9)) AS name
        FROM raw
        WHERE contains(value, chr(9)) AND regexp_matches(string_split(value, chr(9))[1], '^[0-9]+$')""",
)
def parse_or_drop(spark, d):
    raw = table(spark, d, "part").selectExpr(
        r"""CASE WHEN p_size % 7 = 0 THEN p_name
                 WHEN p_size % 5 = 0 THEN concat('x', p_partkey, '\t', p_name)
                 ELSE concat(p_partkey, '\t ', p_name, '\t', p_brand, ' ') END AS value"""
    )
    return R.parse_catalog(raw)


@query(
    "arithmetic_map",
    """SELECT p_partkey, p_size * p_size AS square, p_size * p_size * p_size AS cube,
              p_size % 10 AS last_digit, p_size + 10 AS plus_ten, p_size * 2 AS twice,
              round(p_retailprice / p_size, 6) AS per_unit FROM part""",
)
def arithmetic_map(spark, d):
    size = F.col("p_size")
    return table(spark, d, "part").select(
        "p_partkey",
        (size * size).alias("square"),
        (size * size * size).alias("cube"),
        (size % 10).alias("last_digit"),
        (size + 10).alias("plus_ten"),
        (size * 2).alias("twice"),
        F.round(F.col("p_retailprice") / size, 6).alias("per_unit"),
    )


@query("group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, d):
    register_views(spark, d, "events")
    return spark.sql("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")


@query(
    "count_by_value",
    f"""SELECT n, count(*) AS words FROM (
          SELECT word, count(*) AS n FROM ({TRIMMED_WORDS_SQL}) GROUP BY word) GROUP BY n""",
)
def count_by_value(spark, d):
    """How many words occur how often: a count over counted values."""
    words = words_of_text(documents(spark, d), "text", trim=True)
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.groupBy("n").agg(F.count("*").alias("words"))


@query("count_all", "SELECT count(*) AS n FROM lineitem")
def count_all(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query(
    "typed_average",
    "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS average_salary FROM customer GROUP BY c_mktsegment",
)
def typed_average(spark, d):
    average = F.round(sum_count_average(F.col("c_acctbal")), 4)
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(average.alias("average_salary"))


@query(
    "udaf_average",
    """SELECT o_orderstatus,
              round(coalesce(avg(CASE WHEN o_totalprice > 100000 THEN o_totalprice END), 'nan'::DOUBLE), 4)
                AS average_price
       FROM orders GROUP BY o_orderstatus""",
)
def udaf_average(spark, d):
    """A registered SQL aggregate over (sum, count) pairs that Spark reduced first."""
    register_average(spark, "my_average")
    orders = table(spark, d, "orders").withColumn("price", F.expr("CASE WHEN o_totalprice > 100000 THEN o_totalprice END"))
    orders.groupBy("o_orderstatus").agg(
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("total"), F.count("price").alias("n")
    ).createOrReplaceTempView("price_sums")
    return spark.sql(
        "SELECT o_orderstatus, round(my_average(total, n), 4) AS average_price"
        " FROM price_sums GROUP BY o_orderstatus"
    )


@query(
    "udaf_column_average",
    """SELECT o_orderpriority, round(avg(o_totalprice), 4) AS average_price,
              round(coalesce(avg(CASE WHEN o_custkey < 3 THEN o_totalprice END), 'nan'::DOUBLE), 4) AS average_of_few
       FROM orders GROUP BY o_orderpriority""",
)
def udaf_column_average(spark, d):
    """A registered SQL aggregate over plain columns, in some groups over few values or none."""
    register_column_average(spark)
    table(spark, d, "orders").createOrReplaceTempView("priced_orders")
    return spark.sql(
        "SELECT o_orderpriority, round(average_of(o_totalprice), 4) AS average_price,"
        " round(average_of(CASE WHEN o_custkey < 3 THEN o_totalprice END), 4) AS average_of_few"
        " FROM priced_orders GROUP BY o_orderpriority")


@query(
    "empty_average",
    """SELECT n_nationkey, round(coalesce(avg(c_acctbal), 'nan'::DOUBLE), 4) AS average_balance
       FROM nation LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9000)
         ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
def empty_average(spark, d):
    rich = table(spark, d, "customer").filter("c_mktsegment = 'MACHINERY' AND c_acctbal > 9000")
    joined = table(spark, d, "nation").join(rich, F.expr("c_nationkey = n_nationkey"), "left")
    return joined.groupBy("n_nationkey").agg(
        F.round(average_or_nan(F.col("c_acctbal")), 4).alias("average_balance")
    )


@query(
    "column_stats",
    """SELECT 'o_custkey' AS field, count(o_custkey) AS n, round(avg(o_custkey), 4) AS mean,
              round(stddev_pop(o_custkey), 4) AS stdev, max(o_custkey)::DOUBLE AS max, min(o_custkey)::DOUBLE AS min
       FROM orders
       UNION ALL
       SELECT 'o_totalprice', count(o_totalprice), round(avg(o_totalprice), 4),
              round(stddev_pop(o_totalprice), 4), max(o_totalprice), min(o_totalprice) FROM orders""",
)
def column_stats(spark, d):
    stats = R.column_statistics(table(spark, d, "orders"), "o_custkey", "o_totalprice")
    return stats.withColumns({"mean": F.round("mean", 4), "stdev": F.round("stdev", 4)})


@query("key_filter", "SELECT c_custkey, c_name FROM customer WHERE c_custkey = 42")
def key_filter(spark, d):
    return table(spark, d, "customer").filter("c_custkey = 42").select("c_custkey", "c_name")


@query("order_by", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 5000 ORDER BY s_suppkey")
def order_by(spark, d):
    register_views(spark, d, "supplier")
    return spark.sql("SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 5000 ORDER BY s_suppkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(
    "join_inner_sql",
    """SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_name
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def join_inner_sql(spark, d):
    register_views(spark, d, "orders", "customer")
    return spark.sql(
        "SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_name"
        " FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
    )


@query(
    "canonicalize_ids",
    """WITH first AS (SELECT p_name, min(p_partkey) AS good FROM part GROUP BY p_name),
            alias AS (SELECT p_partkey AS bad, good FROM part JOIN first USING (p_name) WHERE p_partkey <> good)
       SELECT l_suppkey AS user_id, coalesce(good, l_partkey) AS item_id,
              sum(l_quantity)::BIGINT AS plays
       FROM lineitem LEFT JOIN alias ON bad = l_partkey GROUP BY ALL""",
)
def canonicalize_ids(spark, d):
    """Parts of the same name count as one item: the one with the lowest key."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    first = part.groupBy("p_name").agg(F.min("p_partkey").alias("good"))
    alias = part.join(first, "p_name").filter("p_partkey <> good").select(F.col("p_partkey").alias("bad"), "good")
    # Sum per raw id before the lookup: the join then carries one row per pair.
    plays = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("plays"))
    )
    mapped = R.canonical_ids(plays, "item_id", alias)
    return mapped.groupBy("user_id", "item_id").agg(F.sum("plays").alias("plays"))


@query(
    "blocklist_filter",
    f"""SELECT word, count(*) AS n FROM ({TRIMMED_WORDS_SQL})
        WHERE word NOT IN ('val', 'var', 'def') GROUP BY word""",
)
def blocklist_filter(spark, d):
    words = words_of_text(documents(spark, d), "text", trim=True)
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return R.drop_listed(counts, listed(spark, "word", BLOCKED_WORDS), "word")


@query(
    "blocklist_dropped",
    f"""SELECT count(*) FILTER (WHERE word IN ('val', 'var', 'def')) AS dropped, count(*) AS total
        FROM ({TRIMMED_WORDS_SQL})""",
)
def blocklist_dropped(spark, d):
    words = words_of_text(documents(spark, d), "text", trim=True)
    return words.agg(
        F.count_if(F.col("word").isin(BLOCKED_WORDS)).alias("dropped"), F.count("*").alias("total")
    )


@query(
    "distinct_items",
    "SELECT DISTINCT l_suppkey AS user_id, l_partkey AS item_id FROM lineitem",
)
def distinct_items(spark, d):
    pairs = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id")
    )
    return pairs.distinct()


@query(
    "clean_plays",
    """WITH alias_lines AS (
          SELECT p_partkey AS seq, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE (p_partkey % 50 + 1)::VARCHAR END AS bad,
                 CASE WHEN p_partkey % 13 = 0 THEN 'none' ELSE (p_partkey % 7 + 1)::VARCHAR END AS good FROM part),
        alias AS (
          SELECT bad::BIGINT AS bad, arg_max(good::BIGINT, seq) AS good FROM alias_lines
          WHERE bad <> '' AND good <> 'none' GROUP BY 1),
        catalog AS (SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey % 17 <> 0)
        SELECT item_id, name, sum(l_quantity)::BIGINT AS plays FROM (
          SELECT coalesce(good, l_partkey) AS item_id, l_quantity FROM lineitem LEFT JOIN alias ON bad = l_partkey)
        LEFT JOIN catalog ON id = item_id GROUP BY ALL""",
)
def clean_plays(spark, d):
    """Plays by canonical id: catalog and alias lines parsed, bad lines dropped, the last alias of an id wins."""
    part, key = table(spark, d, "part"), F.col("p_partkey")
    bad = F.when(key % 11 == 0, "").otherwise((key % 50 + 1).cast("string"))
    good = F.when(key % 13 == 0, "none").otherwise((key % 7 + 1).cast("string"))
    lines = part.select(key.alias("seq"), F.concat(bad, F.lit("\t"), good).alias("value"))
    alias = R.last_per_key(R.parse_alias(lines, "value", "seq"), "bad", "good", "seq")
    head = F.when(key % 17 == 0, "unknown").otherwise(key.cast("string"))
    catalog = R.parse_catalog(part.select(F.concat(head, F.lit("\t"), "p_name").alias("value")))
    plays = table(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id"), "l_quantity")
    mapped = R.canonical_ids(plays, "item_id", alias.select(F.col("bad").cast("bigint").alias("bad"), F.col("good").cast("bigint").alias("good")))
    sums = mapped.groupBy("item_id").agg(F.sum("l_quantity").cast("bigint").alias("plays"))
    named = catalog.select(F.col("id").cast("bigint").alias("item_id"), "name")
    return sums.join(named, "item_id", "left").select("item_id", "name", "plays")
