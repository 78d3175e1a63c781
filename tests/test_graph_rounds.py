"""Shortest paths in blocks of rounds, ranks for many sources, and edges whose ends are not listed."""

import math
import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import pagerank as PR
from weftline.operators import pregel as P


def graph(seed, n=60, m=240):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n), float(rng.choice([0, 1, 1, 2, 5, 40]))) for _ in range(m)]


def dijkstra(edges, source, ids):
    dist = dict.fromkeys(ids, math.inf)
    dist[source] = 0.0
    for _ in ids:
        for s, d, w in edges:
            dist[d] = min(dist[d], dist[s] + w)
    return dist


@pytest.mark.parametrize("rows_per_split", [1_000_000, 3])
def test_paths_of_any_length_and_split(spark, rows_per_split):
    chain = [(100 + i, 101 + i, 1.0) for i in range(23)] + [(100, 123, 50.0)]
    edges = graph(1) + chain + [(5, 100, 2.0), (5, 5, 0.0), (5, 100, 9.0)]
    ids = {v for s, d, _ in edges for v in (s, d)} | {999}
    got = P.shortest_paths(spark.createDataFrame([(999,)], "id long"), spark.createDataFrame(edges, "src long, dst long, weight double"), 5,
                           rows_per_split=rows_per_split)
    assert {r["id"]: r["dist"] for r in got.collect()} == dijkstra(edges, 5, ids)


def test_paths_from_nowhere_and_without_edges(spark):
    none = spark.createDataFrame([], "src long, dst long, weight double")
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    assert sorted(tuple(r) for r in P.shortest_paths(ids, none, 1).collect()) == [(1, 0.0), (2, math.inf)]
    assert {r["dist"] for r in P.shortest_paths(ids, none, 7).collect()} == {math.inf}


@pytest.mark.parametrize("rows_per_split", [1_000_000, 4])
def test_many_sources_are_as_each_alone(spark, rows_per_split):
    edges = spark.createDataFrame([e[:2] for e in graph(2, 40, 90)], "src long, dst long")
    sources = [r["src"] for r in edges.select("src").distinct().limit(4).collect()]
    wanted = spark.createDataFrame([(s,) for s in [*sources, sources[0]]], "id long")
    got = {(r["source"], r["id"]): r["rank"] for r in PR.pagerank_many(edges, wanted, 7, rows_per_split=rows_per_split).collect()}
    want = {(s, r["id"]): r["rank"] for s in sources for r in PR.pagerank(edges, 7, source=s).collect() if r["rank"] > 0}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_a_source_must_be_a_vertex(spark):
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    with pytest.raises(ValueError):
        PR.pagerank_many(edges, spark.createDataFrame([(3,)], "id long"), 2)
    assert PR.pagerank_many(edges, spark.createDataFrame([], "id long"), 2).collect() == []


def test_messages_of_unlisted_ends_arrive(spark):
    """Vertex 7 only occurs in an edge: it has the given attributes, is active and its message is merged."""
    vertices = spark.createDataFrame([(1, 10), (2, 20)], "id long, high long")
    edges = spark.createDataFrame([(7, 1), (1, 8), (2, 1)], "src long, dst long")
    settings = dict(message=F.col("src_high"), merge=F.max("msg"), update={"high": F.greatest("high", "msg")}, max_rounds=3)
    got = {r["id"]: r["high"] for r in P.pregel(vertices, edges, unknown={"high": F.lit(99)}, **settings).collect()}
    assert got == {1: 99, 2: 20, 7: 99, 8: 99}
    null = {r["id"]: r["high"] for r in P.pregel(vertices, edges, **settings).collect()}
    assert null == {1: 20, 2: 20, 7: None, 8: 20}
    lost = {r["id"]: r["high"] for r in P.pregel(vertices, edges, closed=True, **settings).collect()}
    assert lost == {1: 20, 2: 20}
