import math

import pytest
from pyspark.sql import functions as F

from weftline.operators import graph as G
from weftline.operators import pagerank as PR
from weftline.operators import pregel as P

TOWNS = [(11, "Arn", 120), (12, "Bex", 45), (13, "Cole", 300), (14, "Dun", 80), (15, "Eye", 210), (16, "Fyn", 150)]
ROADS = [(12, 11, 5), (12, 14, 3), (13, 12, 6), (13, 16, 2), (14, 11, 4), (14, 13, 1), (15, 12, 9), (15, 13, 2), (15, 16, 8), (16, 11, 3)]
LINKS = [(1, 2), (2, 3), (3, 1), (4, 1), (4, 2), (5, 4), (1, 5), (6, 5), (3, 2)]
SIZE = {i: n for i, _, n in TOWNS}
NAME = {i: n for i, n, _ in TOWNS}


@pytest.fixture(scope="module")
def roads(spark):
    return (
        spark.createDataFrame(TOWNS, "id bigint, name string, size int"),
        spark.createDataFrame(ROADS, "src bigint, dst bigint, weight int"),
    )


@pytest.fixture(scope="module")
def links(spark):
    return spark.createDataFrame(LINKS, "src bigint, dst bigint")


def relaxed(source, rounds=99):
    dist = {i: math.inf for i in SIZE} | {source: 0}
    for _ in range(rounds):
        dist = {i: min([d, *(dist[s] + w for s, t, w in ROADS if t == i)]) for i, d in dist.items()}
    return dist


def test_missing_vertices_get_the_default(spark, rows):
    users = spark.createDataFrame([(3, "kim", "buyer"), (7, "lou", "seller")], "id bigint, name string, kind string")
    edges = spark.createDataFrame([(3, 7, "pays"), (5, 0, "asks"), (5, 7, "asks")], "src bigint, dst bigint, rel string")
    everyone = G.with_edge_vertices(users, edges, {"name": F.lit("unnamed"), "kind": F.lit("none")})
    assert rows(everyone) == [(0, "unnamed", "none"), (3, "kim", "buyer"), (5, "unnamed", "none"), (7, "lou", "seller")]
    kept, inner = G.subgraph(everyone, edges, F.col("kind") != "none")
    assert rows(inner) == [(3, 7, "pays")] and kept.count() == 2


def test_edges_to_unknown_vertices_are_not_lost(spark, roads, rows):
    vertices, edges = roads
    more = edges.union(spark.createDataFrame([(12, 99, 1), (98, 12, 1)], edges.schema))
    view = G.triplets(vertices, more)
    assert view.count() == len(ROADS) + 2
    assert rows(view.filter("src = 98 OR dst = 99"), "src_name", "dst_name") == [("Bex", None), (None, "Bex")]
    with pytest.raises(Exception, match="not a vertex"):
        G.triplets(vertices, more, missing="error").collect()
    assert G.triplets(vertices, edges, missing="error").count() == len(ROADS)
    found = {r.id: r.dist for r in P.shortest_paths(vertices, more, 15).collect()}
    assert found[99] == found[12] + 1 and found[98] == math.inf


def test_subgraph_needs_both_ends(roads, rows):
    kept, inner = G.subgraph(*roads, F.col("size") > 100)
    assert rows(kept, "id") == sorted((i,) for i, n in SIZE.items() if n > 100)
    assert rows(inner, "src", "dst") == sorted((s, t) for s, t, _ in ROADS if SIZE[s] > 100 and SIZE[t] > 100)


def test_degrees(roads, rows):
    vertices, edges = roads
    ins, outs = ({i: sum(r[k] == i for r in ROADS) for i in SIZE} for k in (1, 0))
    assert rows(G.enrich_degrees(vertices, edges), "id", "in_deg", "out_deg") == sorted((i, ins[i], outs[i]) for i in SIZE)
    assert rows(G.in_degrees(edges)) == sorted((i, n) for i, n in ins.items() if n)
    assert rows(G.out_degrees(edges)) == sorted((i, n) for i, n in outs.items() if n)
    most = lambda d: max(d.items(), key=lambda x: (x[1], -x[0]))
    best = rows(G.highest(G.degrees(edges), {"in": "in_deg", "out": "out_deg", "all": "degree"}))
    assert best == [("all", *most({i: ins[i] + outs[i] for i in SIZE})), ("in", *most(ins)), ("out", *most(outs))]


def test_triplets_and_parallel_edges(roads, rows):
    vertices, edges = roads
    heavy = G.triplets(vertices, edges.filter("weight > 5"))
    assert rows(heavy, "src_name", "dst_name") == sorted((NAME[s], NAME[t]) for s, t, w in ROADS if w > 5)
    assert G.triplets(vertices, edges.union(edges), "src").count() == 2 * len(ROADS)


def test_largest_neighbour(roads, rows):
    best = G.aggregate_messages(*roads, F.struct("src_size", "src_name"), {"best": F.max("msg")}, fields="src")
    want = {t: max((SIZE[s], NAME[s]) for s, u, _ in ROADS if u == t) for _, t, _ in ROADS}
    assert rows(best.select("id", "best.src_name", "best.src_size")) == sorted((t, n, z) for t, (z, n) in want.items())


def test_mean_size_of_larger_neighbours(roads, near):
    found = G.aggregate_messages(
        *roads, F.col("src_size"), {"mean": F.avg("msg")}, when=F.col("src_size") > F.col("dst_size")
    )
    larger = {t: [SIZE[s] for s, u, _ in ROADS if u == t and SIZE[s] > SIZE[t]] for _, t, _ in ROADS}
    near({r.id: r.mean for r in found.collect()}, {t: sum(x) / len(x) for t, x in larger.items() if x})


def test_messages_to_the_source(roads, rows):
    found = G.aggregate_messages(*roads, F.col("dst_size"), {"n": F.count("msg")}, fields="dst", to="src")
    assert rows(found) == sorted((i, n) for i in SIZE if (n := sum(s == i for s, _, _ in ROADS)))


@pytest.mark.parametrize("rows_per_split", [1_000_000, 1])
def test_shortest_paths(spark, roads, rows_per_split, monkeypatch):
    vertices, edges = roads
    real = P.layout
    monkeypatch.setattr(P, "layout", lambda e, _: real(e, rows_per_split))
    assert {r.id: r.dist for r in P.shortest_paths(vertices, edges, 15).collect()} == relaxed(15)
    lonely = vertices.unionByName(spark.createDataFrame([(9, "Zoe", 1)], "id bigint, name string, size int"))
    assert {r.id: r.dist for r in P.shortest_paths(lonely, edges, 15).collect()}[9] == math.inf


def test_pregel_with_both_ends(roads):
    """The same paths, sending only messages that improve the destination."""
    vertices, edges = roads
    start = vertices.select("id", F.when(F.col("id") == 15, 0.0).otherwise(float("inf")).alias("dist"))
    step = F.col("src_dist") + F.col("weight")
    found = P.pregel(
        start, edges, step, F.min("msg"), {"dist": F.least("dist", "msg")},
        when=step < F.col("dst_dist"), fields="both", rows_per_split=2,
    )
    assert {r.id: r.dist for r in found.collect()} == relaxed(15)
    one = P.pregel(start, edges, step, F.min("msg"), {"dist": F.least("dist", "msg")}, when=step < F.col("dst_dist"), fields="both", max_rounds=1)
    assert {r.id: r.dist for r in one.collect()} == relaxed(15, 1)


def ranks(df):
    return {r.id: r.rank for r in df.collect()}


def ranked(edges, rounds, source=None, tol=None):
    """Ranks by plain loops: full rounds, or passing on changes above ``tol``."""
    ids = {i for e in edges for i in e}
    outs = {i: sum(s == i for s, _ in edges) for i in ids}
    first = {i: 1.0 if source is None else float(i == source) for i in ids}
    if tol is None:
        rank = dict(first)
        for _ in range(rounds):
            rank = {i: 0.15 * first[i] + 0.85 * sum(rank[s] / outs[s] for s, t in edges if t == i) for i in ids}
    else:
        rank = {i: 0.15 if source is None else float(i == source) for i in ids}
        change = dict(rank)
        while any(c > tol for c in change.values()):
            change = {i: 0.85 * sum(change[s] / outs[s] for s, t in edges if t == i and change[s] > tol) for i in ids}
            rank = {i: rank[i] + change[i] for i in ids}
    factor = (1.0 if source is not None else len(ids)) / sum(rank.values())
    return {i: r * factor for i, r in rank.items()}


@pytest.mark.parametrize("rows_per_split", [1_000_000, 1])
def test_pagerank_fixed_rounds(links, near, rows_per_split):
    near(ranks(PR.pagerank(links, 10, rows_per_split=rows_per_split)), ranked(LINKS, 10))


def test_pagerank_until_convergence(links, near):
    near(ranks(PR.pagerank_until(links, 1e-4, rows_per_split=1)), ranked(LINKS, 0, tol=1e-4))


def test_personalized_pagerank(links, near):
    near(ranks(PR.pagerank(links, 10, source=6)), ranked(LINKS, 10, source=6))
    near(ranks(PR.pagerank_until(links, 1e-4, source=6)), ranked(LINKS, 0, source=6, tol=1e-4))


def test_pagerank_sums_and_extra_vertices(spark, links):
    extra = spark.createDataFrame([(1,), (8,)], "id bigint")
    got = ranks(PR.pagerank(links, 3, vertices=extra))
    assert len(got) == 7 and abs(sum(got.values()) - 7) < 1e-9
    doubled = ranks(PR.pagerank(links.union(links), 3, vertices=extra))
    assert all(abs(got[v] - doubled[v]) < 1e-9 for v in got)


def test_pagerank_of_no_edges_and_of_an_absent_source(spark, links):
    none = spark.createDataFrame([], "src bigint, dst bigint")
    assert PR.pagerank(none, 2).count() == 0 and PR.pagerank_until(none, 0.1).count() == 0
    for call in (lambda: PR.pagerank(links, 2, source=77), lambda: PR.pagerank_until(links, 0.1, source=77)):
        with pytest.raises(ValueError, match="not a vertex"):
            call()


def test_pagerank_checks(links):
    for call in (
        lambda: PR.pagerank(links, 0), lambda: PR.pagerank(links, 1, reset=1.5),
        lambda: PR.pagerank_until(links, -1.0), lambda: PR.pagerank_until(links, 0.1, reset=-0.1),
    ):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("hot_dst", ["id + 1", "1L"])
def test_hot_source_is_spread_over_partitions(spark, hot_dst):
    """Also when its edges are copies of one edge."""
    hot = spark.range(4000).selectExpr("0L AS src", f"{hot_dst} AS dst")
    cold = spark.range(2000).selectExpr("id + 1 AS src", "0L AS dst")
    placed, sources = G.layout(hot.union(cold), rows_per_split=100)
    per_part = [r[0] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).select("n").collect()]
    assert len(per_part) == 4 and max(per_part) < 2500
    assert sources.filter("splits > 1").count() == 1
    sent = placed.join(P.senders(sources.withColumn("active", F.lit(True))), ["src", "split"])
    assert sent.count() == 6000
    placed.unpersist()
