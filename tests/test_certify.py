"""Certificates hold for what was fitted and fail for what was not."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from weftline.operators import certify, learn, recommend


@pytest.fixture(scope="module")
def ratings(spark):
    rng = random.Random(1)
    rows = [(u, i, float(rng.choice([0, 1, 2, 7, -1]))) for u in range(30) for i in range(20) if rng.random() < 0.3]
    return spark.createDataFrame(rows, "user int, item int, rating double").repartition(3)


class Moved:
    """A model whose user factors are not the solution."""

    def __init__(self, model):
        self.rank, self.itemFactors = model.rank, model.itemFactors
        self.userFactors = model.userFactors.withColumn("features", F.when(F.col("id") == 3, F.transform("features", lambda v: v * 1.01)).otherwise(F.col("features")))


def test_residuals_are_small_only_for_the_solution(ratings):
    model = recommend.fit_implicit(ratings, rank=4, reg=0.05, alpha=2.0)
    found = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, model, 0.05, 2.0).collect()}
    assert found.keys() == {r["user"] for r in ratings.select("user").distinct().collect()} and max(found.values()) < 1e-4
    moved = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, Moved(model), 0.05, 2.0).collect()}
    assert moved[3] > 1e-3 and all(moved[u] == found[u] for u in found if u != 3)
    other = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, model, 0.05, 3.0).collect()}
    assert max(other.values()) > 1e-2


def test_residuals_are_those_of_numpy(ratings):
    model = recommend.fit_implicit(ratings, rank=3, iterations=1, reg=0.1, alpha=1.0)
    moved = Moved(model)
    y = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    x = {r["id"]: np.array(r["features"]) for r in moved.userFactors.collect()}
    gram = sum(np.outer(v, v) for v in y.values())
    got = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, moved, 0.1, 1.0).collect()}
    rated = {}
    for r in ratings.collect():
        rated.setdefault(r["user"], []).append((r["item"], r["rating"]))
    for u, own in rated.items():
        left, right = gram.copy(), np.zeros(3)
        for i, value in own:
            left += abs(value) * np.outer(y[i], y[i])
            right += (value > 0) * (1 + abs(value)) * y[i]
        left += 0.1 * sum(value > 0 for _, value in own) * np.eye(3)
        want = np.abs(left @ x[u] - right).max() / max(np.abs(right).max(), 1e-300)
        assert got[u] == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_scores_are_products(ratings, spark):
    model = recommend.fit_implicit(ratings, rank=3)
    found = recommend.recommend(model, ratings.select("user").limit(5), 3)
    for r in certify.recomputed_scores(found, model).collect():
        assert r["product"] == pytest.approx(r["score"], abs=1e-5)


@pytest.mark.parametrize("steps, optimal", [(200, True), (1, False)])
def test_slopes_vanish_only_at_the_optimum(spark, steps, optimal):
    rng = random.Random(2)
    rows = [(i, float(rng.random() < 0.3 + 0.1 * (i % 5)), float(i % 5), rng.gauss(3, 2), 1.0) for i in range(300)]
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(
        spark.createDataFrame(rows, "id long, label double, a double, b double, c double")).select("id", "label", "features")
    model = learn.fit_logistic(data.select("label", "features"), reg=0.05, overrides={"maxIter": steps, "tol": 1e-12})
    weights = certify.exported_weights(spark, model.coefficients)
    terms = certify.term_rows(data, "features", "id")
    p = certify.recomputed_probability(terms, weights, model.intercept, "id")
    scored = learn.positive_share(model.transform(data)).select("id", "label", "p1").join(p, "id")
    assert scored.where(F.abs(F.col("p1") - F.col("p")) > 1e-9).count() == 0
    slopes = {r["term"]: r for r in certify.logistic_gradient(terms, scored.select("id", "label", "p"), weights, 0.05).collect()}
    assert slopes.keys() == {-1, 0, 1, 2}
    assert (max(abs(r["scaled"]) for r in slopes.values()) < 1e-6) == optimal
    # Against finite sums in plain Python.
    w, p_of = model.coefficients.toArray(), {r["id"]: r["p"] for r in scored.collect()}
    values = np.array([r[3] for r in rows])
    want = sum((p_of[r[0]] - r[1]) * r[3] for r in rows) / 300 + 0.05 * values.var(ddof=1) * w[1]
    assert slopes[1]["gradient"] == pytest.approx(want, abs=1e-9)


def test_a_row_costs_what_it_has(spark):
    from pyspark.ml.linalg import SparseVector, Vectors
    data = spark.createDataFrame(
        [(1, SparseVector(1000, {3: 2.0, 700: -1.0})), (2, Vectors.dense([0.0, 5.0])), (3, SparseVector(9, {}))], ["id", "features"])
    assert sorted(tuple(r) for r in certify.term_rows(data, "features", "id").collect()) == [(1, 3, 2.0), (1, 700, -1.0), (2, 1, 5.0)]


def test_residuals_in_slices_are_the_same(ratings, monkeypatch):
    model = recommend.fit_implicit(ratings, rank=3, iterations=2)
    whole = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, model, 0.01, 1.0).collect()}
    monkeypatch.setattr(certify, "RATINGS_PER_JOB", 40)
    sliced = {r["user"]: r["residual"] for r in certify.implicit_residuals(ratings, model, 0.01, 1.0).collect()}
    assert sliced == pytest.approx(whole, abs=1e-6) and len(sliced) == 30


def test_ratings_move_once_with_factors(ratings):
    """To their user, and no further."""
    model = recommend.fit_implicit(ratings, rank=3, iterations=1)
    plan = certify.implicit_residuals(ratings, model, 0.01, 1.0)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    joins = [n for n, line in enumerate(lines) if "Join Inner" in line and "user" in line]
    inner = [n for n, line in enumerate(lines) if "Join Inner" in line and "item" in line]
    assert joins and inner and max(joins) < min(inner)
