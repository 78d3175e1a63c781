"""Certificates for learned models: what holds of a right solution, recomputed from the exported numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.session import staged

# Ratings of a job that moves an item's factors with each.
RATINGS_PER_JOB = 50_000_000


def vector_sums(column: str, size: int) -> list[Column]:
    """Sums of each component of an array column."""
    return [F.sum(F.col(column)[i]).alias(f"_s{i}") for i in range(size)]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def gram_matrix(factors: DataFrame, rank: int) -> list[list[float]]:
    """Sum over rows of the products of every two components: ``rank`` squared numbers, summed per task first."""
    x = F.transform("features", lambda v: v.cast("double"))
    row = factors.select(x.alias("x")).agg(*[
        F.coalesce(F.sum(F.col("x")[i] * F.col("x")[j]), F.lit(0.0)).alias(f"g{i}_{j}") for i in range(rank) for j in range(i, rank)]).first()
    return [[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(rank)] for i in range(rank)]


def implicit_residuals(ratings: DataFrame, model: ALSModel, reg: float, alpha: float) -> DataFrame:
    """``(user, residual)``: how far each user's factors are from solving their normal equations.

    Implicit feedback weighs a rating r with 1 + alpha |r| and prefers rated
    items (r > 0); the penalty is ``reg`` times the number of items a user
    prefers.  The last half step of the fit solves these equations for the
    users, so for given item factors a residual is rounding, whatever was
    learned.  It is the largest component of left side minus right side, relative
    to the largest of either.  Items' products over all rows are one small
    matrix.  Factors are a multiple of the ratings, so users are worked on in
    slices of about ``RATINGS_PER_JOB`` ratings.
    """
    rank = model.rank
    gram = F.array(*[F.array(*[F.lit(v) for v in row]) for row in gram_matrix(model.itemFactors, rank)])
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    slices = max(1, -(-ratings.count() // RATINGS_PER_JOB))
    found = []
    for slice_no in range(slices):
        mine = F.pmod(F.xxhash64(F.col("user").cast("long")), F.lit(slices)) == slice_no
        found.append(residuals_of(ratings.where(mine), users, items, gram, rank, reg, alpha))
        if slices > 1:
            # Each slice is a job, whose shuffle files go with it.
            found[-1] = staged(found[-1], "residuals")
    return reduce(DataFrame.unionByName, found)


def residuals_of(ratings: DataFrame, users: DataFrame, items: DataFrame, gram: Column, rank: int, reg: float, alpha: float) -> DataFrame:
    """``(user, residual)`` of the users in ``ratings``.

    Ratings meet the items first and move once more, to their user, with the
    item's factors as they are stored; the user's factors and sums are there.
    """
    doubles = lambda c: F.transform(c, lambda v: v.cast("double")).alias(c)
    rated = ratings.select("user", "item", "rating").join(items, "item").join(users, "user").select("user", "rating", doubles("x"), doubles("y"))
    weight = alpha * F.abs("rating")
    liked = F.col("rating") > 0
    # Per rating: its part of (C - 1) Y'Y x, less its part of C Y'p.
    pull = weight * dot(F.col("x"), F.col("y")) - F.when(liked, 1 + weight).otherwise(0.0)
    want = F.when(liked, 1 + weight).otherwise(0.0)
    parts = rated.select("user", F.transform("y", lambda v: v * pull).alias("d"), F.transform("y", lambda v: v * want).alias("w"),
                         liked.cast("long").alias("liked"))
    sums = parts.groupBy("user").agg(
        *vector_sums("d", rank), *[F.sum(F.col("w")[i]).alias(f"_w{i}") for i in range(rank)], F.sum("liked").alias("liked"))
    joined = sums.join(users, "user").withColumn("x", doubles("x"))
    # What is the same for all users: Gram matrix times x, and the penalty.
    whole = F.transform(gram, lambda row: dot(row, F.col("x")))
    both = F.zip_with(whole, F.array(*[F.col(f"_s{i}") for i in range(rank)]), lambda a, b: a + b)
    left = F.zip_with(both, F.col("x"), lambda a, v: a + reg * F.col("liked") * v)
    size = F.greatest(*[F.abs(F.col(f"_w{i}")) for i in range(rank)], F.lit(1e-300))
    return joined.select("user", (F.array_max(F.transform(left, lambda v: F.abs(v))) / size).alias("residual"))


def recomputed_scores(found: DataFrame, model: ALSModel) -> DataFrame:
    """Rows of ``found`` (user, item, score) with ``product``, the score from the exported factors."""
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("x"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    return found.join(users, "user").join(items, "item").withColumn("product", dot(F.col("x"), F.col("y"))).drop("x", "y")


def term_rows(scored: DataFrame, features: str, *keep: str) -> DataFrame:
    """One row for every feature of a row that is not 0: the kept columns, ``term`` and ``value``."""
    numbered = F.transform(vector_to_array(features), lambda v, i: F.struct(i.alias("term"), v.alias("value")))
    # Zeros go before rows are made of the rest.
    return scored.select(*keep, F.inline(F.filter(numbered, lambda t: t["value"] != 0)))


def recomputed_probability(terms: DataFrame, weights: DataFrame, intercept: float, key: str) -> DataFrame:
    """``(key, p)``: probability of class 1 from exported ``weights`` (term, weight), by a join on the term."""
    margins = terms.join(weights, "term").groupBy(key).agg(F.sum(F.col("value") * F.col("weight")).alias("m"))
    return margins.select(key, (1 / (1 + F.exp(-(F.col("m") + F.lit(intercept))))).alias("p"))


def logistic_gradient(terms: DataFrame, rows: DataFrame, weights: DataFrame, reg: float) -> DataFrame:
    """``(term, gradient, scaled)`` of the mean log loss with a ridge penalty, at the given weights; term -1 is the intercept.

    ``rows`` has key, label and p, ``terms`` key, term and value.  The penalty
    is on weights of features that are divided by their standard deviation, so
    a weight's part is ``reg`` times its square.  At the optimum all are 0.
    ``scaled`` is the gradient for a feature of mean square 1.
    """
    key = rows.columns[0]
    n = rows.count()
    error = rows.select(key, (F.col("p") - F.col("label")).alias("error"))
    value = F.col("value")
    sums = terms.join(error, key).groupBy("term").agg(
        F.sum(value * F.col("error")).alias("pull"), F.sum(value).alias("s"), F.sum(value * value).alias("q"))
    variance = (F.col("q") - F.col("s") * F.col("s") / n) / max(n - 1, 1)
    slopes = sums.join(weights, "term").select(
        "term", (F.col("pull") / n + reg * variance * F.col("weight")).alias("gradient"), F.sqrt(F.col("q") / n).alias("size"))
    slopes = slopes.unionByName(error.agg(F.lit(-1).alias("term"), (F.sum("error") / n).alias("gradient"), F.lit(1.0).alias("size")))
    return slopes.select("term", "gradient", (F.col("gradient") / F.col("size")).alias("scaled"))


def exported_weights(spark: SparkSession, coefficients) -> DataFrame:
    """``(term, weight)`` of a fitted vector; it is in the driver anyway."""
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(coefficients.toArray())], "term int, weight double")
