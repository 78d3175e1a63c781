import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import recommend as R

def random_ratings(users, items, hot_user=None, hot_item=None, seed=3):
    rng = random.Random(seed)
    cells = {}
    for u in range(users):
        for i in rng.sample(range(items), rng.randrange(1, 4)):
            cells[u, i] = float(rng.randrange(1, 6))
    for i in range(items):
        if hot_user is not None:
            cells[hot_user, i] = 2.0
    for u in range(0, users, 2):
        if hot_item is not None:
            cells[u, hot_item] = 1.0
    return cells


@pytest.fixture(scope="module")
def small():
    return random_ratings(12, 9, hot_user=2, seed=5)


@pytest.fixture(scope="module")
def stars(spark, small):
    return spark.createDataFrame([(u, i, r) for (u, i), r in small.items()], "user bigint, item bigint, rating double")


@pytest.fixture(scope="module")
def everyone(spark, small):
    return spark.createDataFrame(sorted({(u,) for u, _ in small}), "user bigint")


def distance(cells, by, a, b):
    keys = {k for k in cells if k[0] in (a, b)}
    return math.sqrt(sum((cells.get((a, i), 0) - cells.get((b, i), 0)) ** 2 for i in {i for _, i in keys}))


@pytest.mark.parametrize("hot", [(None, None), (7, 3)])
def test_nearest_matches_brute_force(spark, hot):
    """Also with a user and an item that hold about a third of all rows."""
    cells = random_ratings(40, 25, *hot)
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user bigint, item bigint, rating double")
    users = sorted({u for u, _ in cells})
    got = {}
    for r in R.nearest(ratings, spark.createDataFrame([(u,) for u in users], "user bigint"), 3).collect():
        got.setdefault(r.target, []).append((round(r.distance, 9), r.user))
    for t in users:
        want = sorted((round(distance(cells, None, t, u), 9), u) for u in users if u != t)[:3]
        assert sorted(got[t]) == want, t


def test_item_cf_matches_brute_force(spark):
    cells = random_ratings(30, 20, hot_user=4, hot_item=2)
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user bigint, item bigint, rating double")
    raters = {}
    for u, i in cells:
        raters.setdefault(i, set()).add(u)
    users = sorted({u for u, _ in cells})
    got = {}
    for r in R.item_cf(ratings, spark.createDataFrame([(u,) for u in users], "user bigint"), 4).collect():
        got.setdefault(r.user, []).append((round(r.distance, 9), r.item))
    for u in users:
        seen = {i for v, i in cells if v == u}
        last = raters[max(seen)]
        want = sorted((round(math.sqrt(len(last ^ raters[i])), 9), i) for i in raters if i not in seen)[:4]
        assert sorted(got.get(u, [])) == want, u


def test_pair_statistics_match_brute_force(spark):
    cells = random_ratings(40, 12, hot_user=7, hot_item=3)
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in cells.items()], "user bigint, item bigint, rating double")
    pairs = list(itertools.combinations(range(12), 2))
    stats = R.pair_statistics(ratings, spark.createDataFrame(pairs, "a bigint, b bigint"))
    got = {(r.a, r.b): r for r in stats.collect()}
    assert len(got) == len(pairs)
    for a, b in pairs:
        ra = {u: r for (u, i), r in cells.items() if i == a}
        rb = {u: r for (u, i), r in cells.items() if i == b}
        both = ra.keys() & rb.keys()
        row = got[a, b]
        assert (row.n_both, row.n_a, row.n_b) == (len(both), len(ra), len(rb))
        assert row.dot == sum(ra[u] * rb[u] for u in both)
        assert (row.sum_a, row.sum_b) == (sum(ra[u] for u in both), sum(rb[u] for u in both))
        assert (row.norm_sq_a, row.norm_sq_b) == (sum(r * r for r in ra.values()), sum(r * r for r in rb.values()))


def test_measures(spark):
    one = spark.createDataFrame(
        [(1, 2, 4, 20.0, 8.0, 9.0, 18.0, 23.0, 5, 10, 25.0, 64.0)],
        "a int, b int, n_both bigint, dot double, sum_a double, sum_b double, sq_a double, sq_b double,"
        " n_a bigint, n_b bigint, norm_sq_a double, norm_sq_b double",
    )
    m = R.similarities(one, virtual_count=4.0, prior=0.5).first()
    r = (4 * 20 - 72) / (math.sqrt(4 * 18 - 64) * math.sqrt(4 * 23 - 81))
    assert m.cooccurrence == pytest.approx(4 / math.sqrt(50))
    assert m.correlation == pytest.approx(r)
    assert m.regularized_correlation == pytest.approx(0.5 * r + 0.25)
    assert m.cosine == pytest.approx(0.5)
    assert m.damped_cosine_ab == pytest.approx(80 / (40 * 5 * math.log10(20)))
    assert m.damped_cosine_ba == pytest.approx(80 / (40 * 10 * math.log10(15)))
    assert m.jaccard == pytest.approx(4 / 11)
    flat = one.withColumn("sq_a", F.lit(16.0))
    assert R.similarities(flat).first().correlation is None


def test_edge_pairs(stars, small, rows):
    want = set()
    for u in {u for u, _ in small}:
        own = sorted(i for v, i in small if v == u)
        rated = sorted((small[u, i], i) for i in own)
        want |= {tuple(sorted(p)) for p in ((own[0], own[-1]), (rated[0][1], rated[-1][1])) if p[0] != p[1]}
    assert rows(R.edge_pairs(stars, "user", "item", "item", "rating")) == sorted(want)


def test_user_cf_matches_brute_force(stars, everyone, small):
    users, items = sorted({u for u, _ in small}), sorted({i for _, i in small})
    got = {}
    for r in R.user_cf(stars, everyone).collect():
        got.setdefault(r.user, {})[r.item] = round(r.score, 6)
    for t in users:
        near = sorted((distance(small, None, t, u), u) for u in users if u != t)[:2]
        votes = {i: sum(small.get((u, i), 0) for _, u in near) for i in items}
        mean = sum(votes.values()) / len(items)
        want = {i: round(v + sum(d for d, _ in near), 6) for i, v in votes.items() if v > mean and (t, i) not in small}
        assert got.get(t, {}) == want, t


@pytest.mark.parametrize("measure", ["cosine", "jaccard", "correlation"])
def test_most_similar_items_match_brute_force(spark, stars, small, measure):
    items = sorted({i for _, i in small})
    by_item = {i: {u: r for (u, j), r in small.items() if j == i} for i in items}

    def value(a, b):
        both = sorted(by_item[a].keys() & by_item[b].keys())
        x, y = [by_item[a][u] for u in both], [by_item[b][u] for u in both]
        if measure == "jaccard":
            return len(both) / len(by_item[a].keys() | by_item[b].keys())
        if measure == "cosine":
            return sum(p * q for p, q in zip(x, y)) / math.sqrt(sum(r * r for r in by_item[a].values()) * sum(r * r for r in by_item[b].values()))
        n = len(both)
        spread = math.sqrt(n * sum(p * p for p in x) - sum(x) ** 2) * math.sqrt(n * sum(q * q for q in y) - sum(y) ** 2)
        return (n * sum(p * q for p, q in zip(x, y)) - sum(x) * sum(y)) / spread if spread else None

    got = {}
    for r in R.similar(stars, spark.createDataFrame([(i,) for i in items], "item bigint"), measure, 3).collect():
        got.setdefault(r.target, []).append(round(r.similarity, 9))
    for a in items:
        want = [value(a, b) for b in items if b != a and by_item[a].keys() & by_item[b].keys()]
        assert sorted(got.get(a, []), reverse=True) == sorted((round(v, 9) for v in want if v is not None), reverse=True)[:3], a


@pytest.mark.parametrize("partitions", [1, 7])
def test_twins_are_at_distance_zero(spark, partitions):
    """Equal users with fractional ratings, whatever the order of the sums."""
    rng = random.Random(11)
    data = []
    for pair in range(8):
        for item in rng.sample(range(200), 30):
            rating = rng.uniform(0.1, 9.9)
            data += [(2 * pair, item, rating), (2 * pair + 1, item, rating)]
    rng.shuffle(data)
    ratings = spark.createDataFrame(data, "user bigint, item bigint, rating double").repartition(partitions)
    near = R.nearest(ratings, spark.createDataFrame([(u,) for u in range(16)], "user bigint"), 1).collect()
    assert {r.target: (r.user, r.distance) for r in near} == {u: (u ^ 1, 0.0) for u in range(16)}
    pairs = spark.createDataFrame([(2 * p, 2 * p + 1) for p in range(8)], "a bigint, b bigint")
    found = R.distances(R.pair_statistics(ratings, pairs, member="user", by="item")).collect()
    assert [r.distance for r in found] == [0.0] * 8


@pytest.mark.parametrize("constant", [0.7, 2.3, 0.3, 1.1, 5.0])
def test_a_constant_side_has_no_correlation(spark, constant):
    rng = random.Random(3)
    data = [(u, 1, constant) for u in range(40)] + [(u, 2, rng.uniform(0, 5)) for u in range(40)]
    ratings = spark.createDataFrame(data, "user bigint, item bigint, rating double")
    m = R.similarities(R.pair_statistics(ratings, spark.createDataFrame([(1, 2)], "a bigint, b bigint"))).first()
    assert m.correlation is None and m.regularized_correlation is None


def test_implicit_recommendations(stars, everyone):
    n = everyone.count()
    best = R.recommend(R.fit_implicit(stars), everyone, 3).collect()
    assert len(best) == 3 * n and len({r.user for r in best}) == n
    again = R.recommend(R.fit_implicit(stars), everyone, 3).collect()
    assert sorted((r.user, r.item) for r in best) == sorted((r.user, r.item) for r in again)
