"""Recommender queries: customers rate parts by the quantity they ordered."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from weftline.operators import certify
from weftline.operators import recommend as R
from weftline.operators.ranking import top_per_key
from weftline.operators.simjoin import similar_pairs
from weftline.plans.registry import query
from weftline.session import staged
from weftline.sources.tables import table

RATINGS_SQL = """ratings AS MATERIALIZED (
  SELECT o_custkey AS user, l_partkey AS item, sum(l_quantity) AS rating
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)"""
# The report is about the customers, or parts, that were ordered most by or of.
N_TARGETS = 20
TARGETS_SQL = f"""targets AS MATERIALIZED (
  SELECT user AS target FROM ratings GROUP BY user ORDER BY sum(rating) DESC, user LIMIT {N_TARGETS})"""


# Pairs are compared from this cosine of their rating vectors on.
LEAST_COSINE = 0.2


def pairs_sql(group, member):
    """All pairs whose vectors reach the cosine, by brute force."""
    return f"""lengths AS MATERIALIZED (SELECT {member} AS m, sqrt(sum(rating * rating)) AS len FROM ratings GROUP BY {member}),
      pairs AS MATERIALIZED (SELECT a, b FROM (
        SELECT x.{member} AS a, y.{member} AS b, sum(x.rating * y.rating) AS dot
        FROM ratings x JOIN ratings y ON x.{group} = y.{group} AND x.{member} < y.{member} GROUP BY ALL)
      JOIN lengths p ON p.m = a JOIN lengths q ON q.m = b WHERE dot / (p.len * q.len) >= {LEAST_COSINE})"""


def stats_sql(member, by):
    return f"""stats AS MATERIALIZED (
      SELECT p.a, p.b, count(y.rating) AS n_both, coalesce(sum(x.rating * y.rating), 0) AS dot,
             coalesce(sum(x.rating) FILTER (WHERE y.rating IS NOT NULL), 0) AS sum_a, coalesce(sum(y.rating), 0) AS sum_b,
             coalesce(sum(x.rating * x.rating) FILTER (WHERE y.rating IS NOT NULL), 0) AS sq_a,
             coalesce(sum(y.rating * y.rating), 0) AS sq_b
      FROM pairs p JOIN ratings x ON x.{member} = p.a
      LEFT JOIN ratings y ON y.{member} = p.b AND y.{by} = x.{by} GROUP BY p.a, p.b),
    totals AS MATERIALIZED (SELECT {member} AS m, count(*) AS n, sum(rating * rating) AS sq FROM ratings GROUP BY {member}),
    pair_stats AS MATERIALIZED (
      SELECT s.*, ta.n AS n_a, tb.n AS n_b, ta.sq AS norm_sq_a, tb.sq AS norm_sq_b
      FROM stats s JOIN totals ta ON ta.m = s.a JOIN totals tb ON tb.m = s.b)"""


ITEM_STATS_SQL = f"WITH {RATINGS_SQL}, {pairs_sql('user', 'item')}, {stats_sql('item', 'user')}"
USER_STATS_SQL = f"WITH {RATINGS_SQL}, {pairs_sql('item', 'user')}, {stats_sql('user', 'item')}"


def ratings_of(spark, d):
    """Ratings, written once because every recommender reads them several times."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
    return staged(
        lines.join(orders, "l_orderkey").groupBy("user", "item").agg(F.sum("l_quantity").alias("rating")), "ratings"
    )


def targets_of(ratings):
    total = ratings.groupBy("user").agg(F.sum("rating").alias("total"))
    return total.orderBy(F.desc("total"), "user").limit(N_TARGETS).select("user")


@query(
    "item_pair_stats",
    f"{ITEM_STATS_SQL} SELECT a, b, n_both, dot, sum_a, sum_b, n_a, n_b, norm_sq_a, norm_sq_b FROM pair_stats",
)
def item_pair_stats(spark, d):
    """All parts that are ordered alike, compared over all customers."""
    ratings = ratings_of(spark, d)
    stats = R.pair_statistics(ratings, similar_pairs(ratings, LEAST_COSINE))
    return stats.select("a", "b", "n_both", "dot", "sum_a", "sum_b", "n_a", "n_b", "norm_sq_a", "norm_sq_b")


@query(
    "item_similarity",
    f"""{ITEM_STATS_SQL}, m AS (
          SELECT *, CASE WHEN spread <> 0 THEN (n_both * dot - sum_a * sum_b) / spread END AS r FROM (
            SELECT *, sqrt(n_both * sq_a - sum_a * sum_a) * sqrt(n_both * sq_b - sum_b * sum_b) AS spread FROM pair_stats))
        SELECT a, b, round(n_both / sqrt(n_a * n_b), 6) AS cooccurrence, round(r, 6) AS correlation,
               round(n_both / (n_both + 10.0) * r, 6) AS regularized_correlation,
               round(dot / (sqrt(norm_sq_a) * sqrt(norm_sq_b)), 6) AS cosine,
               round(dot * n_both / (sqrt(norm_sq_a) * sqrt(norm_sq_b) * n_a * log10(10 + n_b)), 6) AS damped_cosine_ab,
               round(dot * n_both / (sqrt(norm_sq_a) * sqrt(norm_sq_b) * n_b * log10(10 + n_a)), 6) AS damped_cosine_ba,
               round(n_both / (n_a + n_b - n_both), 6) AS jaccard FROM m""",
)
def item_similarity(spark, d):
    ratings = ratings_of(spark, d)
    stats = R.pair_statistics(ratings, similar_pairs(ratings, LEAST_COSINE))
    measures = R.similarities(stats)
    return measures.select("a", "b", *[F.round(c, 6).alias(c) for c in measures.columns[2:]])


@query(
    "user_distance",
    f"""{USER_STATS_SQL}
        SELECT a, b, round(sqrt(norm_sq_a + norm_sq_b - 2 * dot), 6) AS distance FROM pair_stats""",
)
def user_distance(spark, d):
    """Distances of all customers that order alike."""
    ratings = ratings_of(spark, d)
    pairs = similar_pairs(ratings, LEAST_COSINE, "user", "item")
    found = R.distances(R.pair_statistics(ratings, pairs, "user", "item"))
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "item_distance",
    f"""{ITEM_STATS_SQL}
        SELECT a, b, round(sqrt(n_a + n_b - 2 * n_both), 6) AS distance FROM pair_stats""",
)
def item_distance(spark, d):
    """Distances of all parts that are ordered alike, by who ordered them: the transposed 0/1 matrix."""
    ratings = ratings_of(spark, d)
    pairs = similar_pairs(ratings, LEAST_COSINE)
    flags = ratings.withColumn("rating", F.lit(1.0))
    found = R.distances(R.pair_statistics(flags, pairs, "item", "user"))
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "item_pairs_above",
    f"""WITH {RATINGS_SQL}, {pairs_sql('user', 'item')} SELECT a, b FROM pairs""",
)
def item_pairs_above(spark, d):
    """Every two parts whose vectors of ordered quantities have at least the cosine."""
    return similar_pairs(ratings_of(spark, d), LEAST_COSINE)


@query(
    "item_similar_top",
    f"""WITH {RATINGS_SQL},
        wanted AS (SELECT item AS a FROM ratings GROUP BY item ORDER BY sum(rating) DESC, item LIMIT {N_TARGETS}),
        norms AS MATERIALIZED (SELECT item, sum(rating * rating) AS sq FROM ratings GROUP BY item),
        dots AS MATERIALIZED (
          SELECT x.item AS a, y.item AS b, sum(x.rating * y.rating) AS dot
          FROM ratings x JOIN wanted w ON w.a = x.item JOIN ratings y ON y.user = x.user AND y.item <> x.item GROUP BY ALL),
        measured AS (SELECT a, b, dot / (sqrt(p.sq) * sqrt(q.sq)) AS s FROM dots JOIN norms p ON p.item = a JOIN norms q ON q.item = b)
        SELECT a AS target, b AS item, round(s, 6) AS similarity FROM (
          SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS r FROM measured) WHERE r <= 5""",
)
def item_similar_top(spark, d):
    """The five parts most like each of the parts that were ordered most, by cosine."""
    ratings = ratings_of(spark, d)
    total = ratings.groupBy("item").agg(F.sum("rating").alias("total"))
    wanted = total.orderBy(F.desc("total"), "item").limit(N_TARGETS).select("item")
    found = R.similar(ratings, wanted, "cosine", 5)
    return found.select("target", "item", F.round("similarity", 6).alias("similarity"))


NEAR_SQL = """norms AS MATERIALIZED (SELECT user, sum(rating * rating) AS q FROM ratings GROUP BY user),
  dots AS MATERIALIZED (SELECT t.user AS target, r.user, sum(t.rating * r.rating) AS dot
    FROM ratings t JOIN targets ON target = t.user JOIN ratings r ON r.item = t.item GROUP BY ALL),
  near AS MATERIALIZED (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY target ORDER BY distance, user) AS p FROM (
      SELECT targets.target, n.user, sqrt(o.q + n.q - 2 * coalesce(dot, 0)) AS distance
      FROM targets JOIN norms o ON o.user = targets.target JOIN norms n ON n.user <> targets.target
      LEFT JOIN dots ON dots.target = targets.target AND dots.user = n.user)) WHERE p <= 2)"""


@query(
    "user_neighbours",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL}, {NEAR_SQL}
        SELECT target, user, round(distance, 6) AS distance FROM near""",
)
def user_neighbours(spark, d):
    ratings = ratings_of(spark, d)
    return R.nearest(ratings, targets_of(ratings), 2).withColumn("distance", F.round("distance", 6))


@query(
    "user_cf_recommend",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL}, {NEAR_SQL},
          scored AS (SELECT t.target, i.item, sum(coalesce(r.rating, 0)) + any_value(t.far) AS score
            FROM (SELECT target, sum(distance) AS far FROM near GROUP BY target) t
            CROSS JOIN (SELECT DISTINCT item FROM ratings) i
            JOIN near n ON n.target = t.target
            LEFT JOIN ratings r ON r.user = n.user AND r.item = i.item GROUP BY t.target, i.item)
        SELECT target AS user, item, round(score, 6) AS score FROM (
          SELECT *, avg(score) OVER (PARTITION BY target) AS mean FROM scored) s
        WHERE score > mean + 1e-9
          AND NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user = s.target AND r.item = s.item)""",
)
def user_cf_recommend(spark, d):
    ratings = ratings_of(spark, d)
    return R.user_cf(ratings, targets_of(ratings)).withColumn("score", F.round("score", 6))


@query(
    "item_cf_recommend",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL},
          last AS MATERIALIZED (SELECT user, max(item) AS anchor FROM ratings JOIN targets ON target = user GROUP BY user),
          sizes AS MATERIALIZED (SELECT item, count(*) AS n FROM ratings GROUP BY item),
          both_sides AS MATERIALIZED (SELECT l.anchor, b.item, count(*) AS n FROM (SELECT DISTINCT anchor FROM last) l
            JOIN ratings a ON a.item = l.anchor JOIN ratings b ON b.user = a.user GROUP BY ALL)
        SELECT user, item, round(distance, 6) AS distance FROM (
          SELECT *, row_number() OVER (PARTITION BY user ORDER BY distance, item) AS p FROM (
            SELECT l.user, s.item, sqrt(h.n + s.n - 2 * coalesce(c.n, 0)) AS distance
            FROM last l JOIN sizes h ON h.item = l.anchor CROSS JOIN sizes s
            LEFT JOIN both_sides c ON c.anchor = l.anchor AND c.item = s.item
            WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user = l.user AND r.item = s.item))) WHERE p <= 10""",
)
def item_cf_recommend(spark, d):
    ratings = ratings_of(spark, d)
    return R.item_cf(ratings, targets_of(ratings), 10).withColumn("distance", F.round("distance", 6))


@query(
    "user_known_items",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL}
        SELECT user, p_partkey AS item, p_name AS name FROM ratings
        JOIN targets ON target = user JOIN part ON p_partkey = item""",
)
def user_known_items(spark, d):
    ratings = ratings_of(spark, d)
    names = table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    known = ratings.join(targets_of(ratings), "user", "left_semi").select("user", "item")
    return known.join(names, "item").select("user", "item", "name")


@query("als_recommend")
def als_recommend(spark, d):
    """Five parts with names for each of the customers that ordered most."""
    ratings = ratings_of(spark, d)
    best = R.recommend(R.fit_implicit(ratings), targets_of(ratings), 5)
    names = table(spark, d, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    return best.join(names, "item").select("user", "item", "name", F.round("score", 4).alias("score"))


@query(
    "als_recommend_form",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL}
        SELECT target AS user, 5::BIGINT AS n_items, true AS named, true AS different, true AS scored FROM targets""",
)
def als_recommend_form(spark, d):
    """What holds for the recommendations whatever the factors are: five different, named and scored parts for every customer asked for."""
    found = staged(als_recommend(spark, d), "lists")
    lists = found.groupBy("user").agg(
        F.count("*").alias("n_items"), F.count("name").alias("n_named"), F.count_distinct("item").alias("n_different"),
        F.count_if(F.isnan("score") | F.col("score").isNull()).alias("n_bad"))
    n = F.col("n_items")
    return lists.select(
        F.col("user").cast("bigint").alias("user"), "n_items", (F.col("n_named") == n).alias("named"), (F.col("n_different") == n).alias("different"), (F.col("n_bad") == 0).alias("scored"))


# The settings of the factorisation.
REG, ALPHA = 0.01, 1.0


@query("als_residual", f"WITH {RATINGS_SQL} SELECT DISTINCT user::BIGINT AS user, true AS solved FROM ratings")
def als_residual(spark, d):
    """Whether every customer's factors solve the normal equations that the parts' factors and all ratings give them."""
    ratings = ratings_of(spark, d)
    found = certify.implicit_residuals(ratings, R.fit_implicit(ratings, reg=REG, alpha=ALPHA), REG, ALPHA)
    return found.select(F.col("user").cast("bigint").alias("user"), (F.col("residual") < 1e-4).alias("solved"))


@query(
    "als_scores",
    f"""WITH {RATINGS_SQL}, {TARGETS_SQL} SELECT target AS user, p::BIGINT AS place, true AS recomputed, true AS best FROM targets CROSS JOIN range(1, 6) r(p)""",
)
def als_scores(spark, d):
    """The recommended scores are the products of the factors, and no other part has a higher one."""
    ratings = ratings_of(spark, d)
    targets = targets_of(ratings)
    model = R.fit_implicit(ratings, reg=REG, alpha=ALPHA)
    best = certify.recomputed_scores(staged(R.recommend(model, targets, 5), "lists"), model)
    placed = best.withColumn("place", F.row_number().over(Window.partitionBy("user").orderBy(F.desc("product"), "item")))
    # The fifth largest of all products: every part against the customers asked for, whose factors are few numbers.
    asked = model.userFactors.join(targets.select(F.col("user").alias("id")), "id", "left_semi").collect()
    users = F.array(*[F.struct(F.lit(r["id"]).alias("user"), F.array(*map(F.lit, r["features"])).alias("x")) for r in asked])
    every = model.itemFactors.select("features", F.explode(users).alias("u")).select("u.user", certify.dot(F.col("u.x"), F.col("features")).alias("product"))
    fifth = top_per_key(every, "user", [F.desc("product")], 5).groupBy("user").agg(F.min("product").alias("fifth"))
    near = 1e-5
    return placed.join(fifth, "user").select(
        F.col("user").cast("bigint").alias("user"), F.col("place").cast("bigint").alias("place"),
        (F.abs(F.col("score") - F.col("product")) < near).alias("recomputed"), (F.col("product") >= F.col("fifth") - near).alias("best"))
