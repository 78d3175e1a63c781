"""Neighbourhood and implicit-feedback recommenders over ``(user, item, rating)`` rows.

Ratings are unique per (user, item); a missing row means 0.  Nothing here
pairs up the rows of a user or an item among themselves: statistics are
computed for the pairs that are asked for, and neighbours for the targets
that are asked for.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import similarity as sim
from weftline.operators.ranking import first_absent, global_rank, top_per_key
from weftline.operators.relational import broadcast_if_small
from weftline.session import collecting, cut_lineage, have_checkpoints, staged

# Blocks of a factorisation: so many ratings in each, if there are more than so many blocks.
RATINGS_PER_BLOCK, LEAST_BLOCKS = 2_000_000, 32


def edge_pairs(ratings: DataFrame, group: str, member: str, *orders: str) -> DataFrame:
    """Per group the members at both ends of each order, as pairs ``a < b``.

    At most one pair per group and order, found by min/max aggregation, so a
    group of any size costs one row per task.
    """
    ends = []
    for order in orders:
        by = F.struct(order, member) if order != member else F.struct(member)
        ends.append(F.struct(F.min(by)[member].alias("x"), F.max(by)[member].alias("y")).alias(order))
    found = ratings.groupBy(group).agg(*ends).select(F.inline(F.array(*orders)))
    return (
        found.filter("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def pair_statistics(ratings: DataFrame, pairs: DataFrame, member: str = "item", by: str = "user") -> DataFrame:
    """Sums over common raters of each requested pair ``(a, b)``, and totals of both sides.

    A pair is looked up from its rarer side: the raters of that side are
    probed against the other side by the unique (member, rater) key.  The
    work is the sum over pairs of the smaller rater count, so a pair with a
    very popular member costs no more than its other member.  Ratings of
    members in no pair are left out before anything moves.
    """
    if not hasattr(pairs, "staged_at"):
        pairs = staged(pairs.select("a", "b"), "pairs")
    named = pairs.select(F.explode(F.array("a", "b")).alias(member)).distinct()
    ratings = ratings.join(broadcast_if_small(named), member, "left_semi")
    totals = ratings.groupBy(member).agg(
        F.count("*").alias("n"), F.sum(F.col("rating") * F.col("rating")).alias("sq")
    )

    def side(name):
        return totals.select(F.col(member).alias(name), F.col("n").alias(f"n_{name}"), F.col("sq").alias(f"norm_sq_{name}"))

    sized = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    a_rarer = F.col("n_a") <= F.col("n_b")
    oriented = sized.select(
        *sized.columns, a_rarer.alias("from_a"),
        F.when(a_rarer, F.col("a")).otherwise(F.col("b")).alias("rare"),
        F.when(a_rarer, F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    raters = ratings.select(F.col(member).alias("rare"), F.col(by).alias("rater"), F.col("rating").alias("r1"))
    probe = ratings.select(F.col(member).alias("other"), F.col(by).alias("rater"), F.col("rating").alias("r2"))
    # Outer, so that pairs without a common rater stay; r2 tells the common ones.
    looked_up = oriented.join(raters, "rare").join(probe, ["other", "rater"], "left")
    shared = F.col("r2").isNotNull()
    ra = F.when(shared, F.when(F.col("from_a"), F.col("r1")).otherwise(F.col("r2")))
    rb = F.when(shared, F.when(F.col("from_a"), F.col("r2")).otherwise(F.col("r1")))
    rows = looked_up.select("a", "b", "n_a", "n_b", "norm_sq_a", "norm_sq_b", ra.alias("ra"), rb.alias("rb"))
    return rows.groupBy("a", "b").agg(
        *[F.max(c).alias(c) for c in ("n_a", "n_b", "norm_sq_a", "norm_sq_b")],
        F.count("ra").alias("n_both"),
        *[
            F.coalesce(F.sum(F.col(x) * F.col(y) if y else F.col(x)), F.lit(0.0)).alias(name)
            for name, x, y in (
                ("dot", "ra", "rb"), ("sum_a", "ra", None), ("sum_b", "rb", None),
                ("sq_a", "ra", "ra"), ("sq_b", "rb", "rb"),
            )
        ],
    )


def similarities(stats: DataFrame, virtual_count: float = 10.0, prior: float = 0.0) -> DataFrame:
    """All similarity measures of pair statistics; the damped cosine in both directions."""
    c = F.col
    norm_a, norm_b = F.sqrt("norm_sq_a"), F.sqrt("norm_sq_b")
    plain = sim.correlation(c("n_both"), c("dot"), c("sum_a"), c("sum_b"), c("sq_a"), c("sq_b"))
    return stats.select(
        "a", "b",
        sim.cooccurrence(c("n_both"), c("n_a"), c("n_b")).alias("cooccurrence"),
        plain.alias("correlation"),
        sim.regularized_correlation(c("n_both"), plain, virtual_count, prior).alias("regularized_correlation"),
        sim.cosine(c("dot"), norm_a, norm_b).alias("cosine"),
        sim.damped_cosine(c("dot"), norm_a, norm_b, c("n_both"), c("n_a"), c("n_b")).alias("damped_cosine_ab"),
        sim.damped_cosine(c("dot"), norm_a, norm_b, c("n_both"), c("n_b"), c("n_a")).alias("damped_cosine_ba"),
        sim.jaccard(c("n_both"), c("n_a"), c("n_b")).alias("jaccard"),
    )


def distances(stats: DataFrame) -> DataFrame:
    """Euclidean distance of each pair from norms and dot product."""
    return stats.select(
        "a", "b", F.sqrt(sim.squared_distance(F.col("norm_sq_a"), F.col("norm_sq_b"), F.col("dot"))).alias("distance")
    )


def similar(
    ratings: DataFrame, targets: DataFrame, measure: str, k: int, member: str = "item", by: str = "user",
    virtual_count: float = 10.0, prior: float = 0.0,
) -> DataFrame:
    """``(target, member, similarity)``: the ``k`` members most similar to each target by a measure of :func:`similarities`.

    Candidates are all members that share a rater with the target; without one
    there is no similarity.  Only target rows are matched with the table, and
    sums combine per task.  Ties go to the lower id.
    """
    named = targets.select(F.col(targets.columns[0]).alias(member)).distinct()
    mine = ratings.join(named, member, "left_semi").select(F.col(member).alias("a"), by, F.col("rating").alias("ra"))
    other = ratings.select(F.col(member).alias("b"), by, F.col("rating").alias("rb"))
    sums = mine.join(other, by).filter("a <> b").groupBy("a", "b").agg(
        F.count("*").alias("n_both"),
        *[F.sum(F.expr(text)).alias(name) for name, text in (
            ("dot", "ra * rb"), ("sum_a", "ra"), ("sum_b", "rb"), ("sq_a", "ra * ra"), ("sq_b", "rb * rb"))],
    )
    totals = ratings.groupBy(member).agg(F.count("*").alias("n"), F.sum(F.col("rating") * F.col("rating")).alias("sq"))
    for side in ("a", "b"):
        sums = sums.join(totals.select(F.col(member).alias(side), F.col("n").alias(f"n_{side}"), F.col("sq").alias(f"norm_sq_{side}")), side)
    found = similarities(sums, virtual_count, prior).select(
        F.col("a").alias("target"), F.col("b").alias(member), F.col(measure).alias("similarity")).filter("similarity IS NOT NULL")
    return top_per_key(found, "target", [F.desc("similarity"), F.col(member)], k)


def dot_products(ratings: DataFrame, targets: DataFrame, member: str, by: str) -> DataFrame:
    """``(target, member, dot)`` for all members that share a rater with a target.

    Only target rows are matched with the table, and sums combine per task,
    so the work is the table size times the targets of a rating at most.
    """
    wanted = ratings.join(targets.select(F.col("target").alias(member)), member, "left_semi")
    mine = wanted.select(F.col(member).alias("target"), by, F.col("rating").alias("mine"))
    return (
        mine.join(ratings, by)
        .groupBy("target", member)
        .agg(F.sum(F.col("mine") * F.col("rating")).alias("dot"))
    )


def nearest(ratings: DataFrame, targets: DataFrame, k: int, member: str = "user", by: str = "item") -> DataFrame:
    """``(target, member, distance)``: the ``k`` nearest others of each target.

    ``d² = |t|² + |m|² - 2 t·m``.  Members that share a rater get their dot
    product from a join.  Of all the others, whose dot product is 0, only
    those of smallest norm can be near: the first ``k`` of the norm order that
    share nothing with the target.
    """
    targets = cut_lineage(targets.select(F.col(targets.columns[0]).alias("target")).distinct())
    norms = ratings.groupBy(member).agg(F.sum(F.col("rating") * F.col("rating")).alias("norm_sq"))
    ranked = global_rank(norms, ["norm_sq", member])
    shared = cut_lineage(dot_products(ratings, targets, member, by).join(ranked, member))
    apart = first_absent(shared.select("target", "rank"), targets, "target", ranked.count(), k).join(ranked, "rank")
    candidates = (
        shared.filter(F.col(member) != F.col("target"))
        .select("target", member, "norm_sq", "dot")
        .unionByName(
            apart.filter(F.col(member) != F.col("target")).select("target", member, "norm_sq", F.lit(0.0).alias("dot"))
        )
    )
    own = norms.select(F.col(member).alias("target"), F.col("norm_sq").alias("own_sq"))
    measured = candidates.join(own, "target").select(
        "target", member, F.sqrt(sim.squared_distance(F.col("own_sq"), F.col("norm_sq"), F.col("dot"))).alias("distance")
    )
    return top_per_key(measured, "target", [F.col("distance"), F.col(member)], k)


def user_cf(ratings: DataFrame, targets: DataFrame, k: int = 2) -> DataFrame:
    """``(user, item, score)`` from the ``k`` nearest users, unseen items only.

    The score of an item sums rating and distance of the neighbours; items
    above the mean score over all items are kept.  The distances are the same
    for every item, so the comparison is between rating sums and the mean
    rating sum.  Ratings must not be negative: then items no neighbour rated
    can never pass.
    """
    n_items = ratings.select("item").distinct().count()
    near = cut_lineage(nearest(ratings, targets, k))
    voted = near.join(ratings, "user").groupBy("target", "item").agg(F.sum("rating").alias("votes"))
    far = near.groupBy("target").agg(F.sum("distance").alias("far"))
    mean = voted.groupBy("target").agg((F.sum("votes") / F.lit(n_items)).alias("mean"))
    kept = voted.join(mean, "target").filter("votes > mean").join(far, "target")
    seen = ratings.select(F.col("user").alias("target"), "item")
    return kept.join(seen, ["target", "item"], "left_anti").select(
        F.col("target").alias("user"), "item", (F.col("votes") + F.col("far")).alias("score")
    )


def item_cf(ratings: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """``(user, item, distance)``: the ``k`` unseen items nearest to the user's last seen item.

    Items are compared by who rated them.  The last seen item is the one with
    the highest id.  Everything a user has seen shares that user with the last
    item, so items that share no rater with it are unseen.
    """
    flags = ratings.filter("rating > 0").select("user", "item", F.lit(1.0).alias("rating"))
    users = cut_lineage(targets.select(F.col(targets.columns[0]).alias("user")).distinct())
    seen = flags.join(users, "user", "left_semi").select("user", "item")
    last = cut_lineage(seen.groupBy("user").agg(F.max("item").alias("target")))
    anchors = last.select("target").distinct()
    raters = flags.groupBy("item").agg(F.sum("rating").alias("norm_sq"))
    ranked = global_rank(raters, ["norm_sq", "item"])
    shared = cut_lineage(dot_products(flags, anchors, "item", "user").join(ranked, "item"))
    apart = first_absent(shared.select("target", "rank"), anchors, "target", ranked.count(), k).join(ranked, "rank")
    near = last.join(shared, "target").join(seen, ["user", "item"], "left_anti")
    candidates = near.select("user", "target", "item", "norm_sq", "dot").unionByName(
        last.join(apart, "target").select("user", "target", "item", "norm_sq", F.lit(0.0).alias("dot"))
    )
    own = raters.select(F.col("item").alias("target"), F.col("norm_sq").alias("own_sq"))
    measured = candidates.join(own, "target").select(
        "user", "item", F.sqrt(sim.squared_distance(F.col("own_sq"), F.col("norm_sq"), F.col("dot"))).alias("distance")
    )
    return top_per_key(measured, "user", [F.col("distance"), F.col("item")], k)


def fit_implicit(
    ratings: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, alpha: float = 1.0, seed: int = 17
) -> ALSModel:
    """Implicit-feedback factorisation; user and item ids must fit an int.

    Every half step sends the factors of a member to each block that needs them,
    so blocks are no more than their ratings ask for, and the files of the steps
    before go while the fit goes on.
    """
    spark = ratings.sparkSession
    asked = -(-ratings.count() // RATINGS_PER_BLOCK)
    blocks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(LEAST_BLOCKS, spark.sparkContext.defaultParallelism, asked))
    als = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
        userCol="user", itemCol="item", ratingCol="rating", checkpointInterval=1,
    )
    have_checkpoints(spark)
    with collecting(spark):
        return als.fit(ratings)


def recommend(model: ALSModel, users: DataFrame, k: int) -> DataFrame:
    """``(user, item, score)``: the ``k`` best items of the given users, known ones included."""
    lists = model.recommendForUserSubset(users.select("user").distinct(), k)
    return lists.select("user", F.inline("recommendations")).withColumnRenamed("rating", "score")
