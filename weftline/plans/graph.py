"""Graph queries: suppliers and parts as vertices, deliveries as weighted edges.

Ids of both kinds share one id space, so supplier ids are also part ids and
the graph has cycles.  Vertex attributes come from ``customer`` by id; the ids
it lacks show the default attributes.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import graph as G
from weftline.operators import pagerank as PR
from weftline.operators import pregel as P
from weftline.plans.registry import query
from weftline.sources.tables import table

EDGES_SQL = "edges AS (SELECT l_suppkey AS src, l_partkey AS dst, l_quantity AS weight FROM lineitem)"
VERTICES_SQL = """ids AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
  vertices AS (SELECT id, coalesce(c_name, 'unnamed') AS name, coalesce(c_acctbal, 0.0) AS age
               FROM (SELECT id FROM ids UNION SELECT c_custkey FROM customer)
               LEFT JOIN customer ON c_custkey = id)"""
GRAPH_SQL = f"WITH {EDGES_SQL}, {VERTICES_SQL}"


def edges_of(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_quantity").alias("weight")
    )


def graph_of(spark, d):
    edges = edges_of(spark, d)
    known = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("age")
    )
    default = {"name": F.lit("unnamed"), "age": F.lit(0.0)}
    return G.with_edge_vertices(known, edges, default), edges


@query("graph_build_default", f"{GRAPH_SQL} SELECT id, name, age FROM vertices")
def graph_build_default(spark, d):
    return graph_of(spark, d)[0]


@query(
    "graph_filters",
    f"""{GRAPH_SQL}
        SELECT 'rich' AS measure, count(*) AS n FROM vertices WHERE age > 3000
        UNION ALL SELECT 'backward', count(*) FROM edges WHERE src > dst
        UNION ALL SELECT 'heavy', count(*) FROM edges WHERE weight > 25""",
)
def graph_filters(spark, d):
    vertices, edges = graph_of(spark, d)
    rich = vertices.agg(F.lit("rich").alias("measure"), F.count_if(F.col("age") > 3000).alias("n"))
    counted = edges.agg(
        F.count_if(F.col("src") > F.col("dst")).alias("b"), F.count_if(F.col("weight") > 25).alias("h")
    ).selectExpr("stack(2, 'backward', b, 'heavy', h) AS (measure, n)")
    return rich.unionByName(counted)


@query(
    "triplets_view",
    f"""{GRAPH_SQL}
        SELECT e.src, e.dst, s.name || ' -> ' || t.name || ': ' || e.weight::INTEGER AS fact
        FROM edges e JOIN vertices s ON s.id = e.src JOIN vertices t ON t.id = e.dst WHERE e.weight > 5""",
)
def triplets_view(spark, d):
    vertices, edges = graph_of(spark, d)
    view = G.triplets(vertices, edges.filter("weight > 5"))
    fact = F.concat("src_name", F.lit(" -> "), "dst_name", F.lit(": "), F.col("weight").cast("int"))
    return view.select("src", "dst", fact.alias("fact"))


@query(
    "degrees",
    f"""WITH {EDGES_SQL}
        SELECT id, sum(i)::BIGINT AS in_deg, sum(o)::BIGINT AS out_deg, count(*) AS degree
        FROM (SELECT src AS id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY id""",
)
def degrees(spark, d):
    return G.degrees(edges_of(spark, d))


@query(
    "max_degrees",
    f"""WITH {EDGES_SQL},
        deg AS (SELECT 'in' AS kind, dst AS id, count(*) AS degree FROM edges GROUP BY dst
                UNION ALL SELECT 'out', src, count(*) FROM edges GROUP BY src
                UNION ALL SELECT 'all', id, count(*) FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY id)
        SELECT kind, id, degree FROM (
          SELECT *, row_number() OVER (PARTITION BY kind ORDER BY degree DESC, id) AS r FROM deg) WHERE r = 1""",
)
def max_degrees(spark, d):
    return G.highest(G.degrees(edges_of(spark, d)), {"in": "in_deg", "out": "out_deg", "all": "degree"})


@query(
    "degree_enrich",
    f"""{GRAPH_SQL}
        SELECT v.id, v.name, coalesce(i.n, 0) AS in_deg, coalesce(o.n, 0) AS out_deg,
               coalesce(i.n, 0) = coalesce(o.n, 0) AS balanced
        FROM vertices v LEFT JOIN (SELECT dst, count(*) AS n FROM edges GROUP BY dst) i ON i.dst = v.id
        LEFT JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) o ON o.src = v.id""",
)
def degree_enrich(spark, d):
    enriched = G.enrich_degrees(*graph_of(spark, d))
    return enriched.select("id", "name", "in_deg", "out_deg", (F.col("in_deg") == F.col("out_deg")).alias("balanced"))


@query(
    "graph_maps",
    f"""{GRAPH_SQL}
        SELECT e.src, e.dst, e.weight * 2 AS twice, round(s.age + 10, 4) AS older
        FROM edges e JOIN vertices s ON s.id = e.src""",
)
def graph_maps(spark, d):
    """Vertex map (age + 10), edge map (weight * 2) and a triplet map that needs only the source."""
    vertices, edges = graph_of(spark, d)
    older = vertices.select("id", (F.col("age") + 10).alias("age"))
    doubled = edges.select("src", "dst", (F.col("weight") * 2).alias("twice"))
    return G.triplets(older, doubled, "src").select("src", "dst", "twice", F.round("src_age", 4).alias("older"))


@query(
    "subgraph",
    f"""{GRAPH_SQL}, kept AS (SELECT id FROM vertices WHERE age > 3000)
        SELECT src, dst, weight FROM edges
        WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept)""",
)
def subgraph(spark, d):
    return G.subgraph(*graph_of(spark, d), F.col("age") > 3000)[1]


@query(
    "aggregate_messages",
    f"""{GRAPH_SQL}
        SELECT e.dst AS id, count(*) AS n, round(sum(s.age * e.weight), 2) AS total
        FROM edges e JOIN vertices s ON s.id = e.src GROUP BY e.dst""",
)
def aggregate_messages(spark, d):
    vertices, edges = graph_of(spark, d)
    return G.aggregate_messages(
        vertices.select("id", "age"), edges, F.col("src_age") * F.col("weight"),
        {"n": F.count("msg"), "total": F.round(F.sum("msg"), 2)}, fields="src",
    )


@query(
    "oldest_follower",
    f"""{GRAPH_SQL}, best AS (
          SELECT dst, name, age FROM (
            SELECT e.dst, s.name, s.age, row_number() OVER (PARTITION BY e.dst ORDER BY s.age DESC, s.id DESC) AS r
            FROM edges e JOIN vertices s ON s.id = e.src) WHERE r = 1)
        SELECT v.id, CASE WHEN b.dst IS NULL THEN v.name || ': nobody'
             ELSE v.name || ': ' || b.name END AS fact
        FROM vertices v LEFT JOIN best b ON b.dst = v.id""",
)
def oldest_follower(spark, d):
    vertices, edges = graph_of(spark, d)
    best = G.aggregate_messages(
        vertices, edges.select("src", "dst"),
        F.struct(F.col("src_age").alias("age"), F.col("src").alias("id"), F.col("src_name").alias("name")),
        {"best": F.max("msg")}, fields="src",
    )
    fact = F.when(
        F.col("best").isNull(), F.concat("name", F.lit(": nobody"))
    ).otherwise(F.concat("name", F.lit(": "), "best.name"))
    return vertices.join(best, "id", "left").select("id", fact.alias("fact"))


@query(
    "older_follower_avg",
    f"""{GRAPH_SQL}
        SELECT e.dst AS id, sum(round(s.age * 100)::BIGINT)::DOUBLE / count(*) AS mean_cents
        FROM edges e JOIN vertices s ON s.id = e.src JOIN vertices t ON t.id = e.dst
        WHERE s.age > t.age GROUP BY e.dst""",
)
def older_follower_avg(spark, d):
    vertices, edges = graph_of(spark, d)
    sums = G.aggregate_messages(
        vertices.select("id", "age"), edges.select("src", "dst"), F.round(F.col("src_age") * 100).cast("bigint"),
        {"n": F.count("msg"), "total": F.sum("msg")}, when=F.col("src_age") > F.col("dst_age"),
    )
    return sums.select("id", (F.col("total") / F.col("n")).alias("mean_cents"))


def paths_sql(rounds):
    """Shortest distances by ``rounds`` rounds of relaxation over all edges."""
    steps = ["p0 AS MATERIALIZED (SELECT id, CASE WHEN id = 5 THEN 0.0 ELSE 'inf'::DOUBLE END AS dist FROM vertices)"]
    for k in range(1, rounds + 1):
        steps.append(
            f"""p{k} AS MATERIALIZED (SELECT id, min(dist) AS dist FROM (
                  SELECT id, dist FROM p{k - 1} UNION ALL
                  SELECT e.dst, p.dist + e.weight FROM p{k - 1} p JOIN edges e ON e.src = p.id) GROUP BY id)"""
        )
    return f"{GRAPH_SQL}, {', '.join(steps)} SELECT id, dist FROM p{rounds}"


@query("sssp", paths_sql(20))
def sssp(spark, d):
    vertices, edges = graph_of(spark, d)
    return P.shortest_paths(vertices, edges, source=5)


def reach_sql(rounds):
    """Largest id that a vertex reaches, by ``rounds`` rounds over all edges."""
    steps = ["p0 AS MATERIALIZED (SELECT id, id AS high FROM (SELECT src AS id FROM edges UNION SELECT dst FROM edges))"]
    for k in range(1, rounds + 1):
        steps.append(
            f"""p{k} AS MATERIALIZED (SELECT id, max(high) AS high FROM (
                  SELECT id, high FROM p{k - 1} UNION ALL
                  SELECT e.src, p.high FROM p{k - 1} p JOIN edges e ON e.dst = p.id) GROUP BY id)"""
        )
    return f"WITH {EDGES_SQL}, {', '.join(steps)} SELECT id, high FROM p{rounds}"


@query("pregel_generic", reach_sql(20))
def pregel_generic(spark, d):
    """Largest id within reach: an initial message, messages against the edges, and active receivers only."""
    edges = edges_of(spark, d).select("src", "dst").distinct()
    start = G.edge_ids(edges).withColumn("high", F.lit(-1).cast("bigint"))
    return P.pregel(
        start, edges, message=F.col("dst_high"), merge=F.max("msg"), update={"high": F.greatest("high", "msg")},
        when=F.col("dst_high") > F.col("src_high"), fields="both", initial={"high": F.col("id")}, active="dst", to="src",
    )


RANK_SQL = f"""WITH {EDGES_SQL},
  links AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM edges GROUP BY src, dst),
  outs AS MATERIALIZED (SELECT src, count(*) AS out_deg FROM edges GROUP BY src),
  shares AS MATERIALIZED (SELECT l.src, l.dst, l.n / o.out_deg AS share FROM links l JOIN outs o USING (src)),
  vertices AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges)"""


def fixed_rank_sql(rounds, source=None):
    """PageRank of a fixed number of rounds, scaled at the end."""
    start = "1.0" if source is None else f"CASE WHEN id = {source} THEN 1.0 ELSE 0.0 END"
    reset = "0.15" if source is None else f"CASE WHEN v.id = {source} THEN 0.15 ELSE 0.0 END"
    total = "(SELECT count(*) FROM vertices)" if source is None else "1.0"
    steps = [f"p0 AS MATERIALIZED (SELECT id, {start}::DOUBLE AS r FROM vertices)"]
    for k in range(1, rounds + 1):
        steps.append(
            f"""p{k} AS MATERIALIZED (SELECT v.id, {reset} + 0.85 * coalesce(m.s, 0) AS r FROM vertices v LEFT JOIN (
                  SELECT s.dst, sum(p.r * s.share) AS s FROM p{k - 1} p JOIN shares s ON s.src = p.id GROUP BY s.dst) m
                ON m.dst = v.id)"""
        )
    return f"""{RANK_SQL}, {', '.join(steps)}
        SELECT id, round(r * {total} / (SELECT sum(r) FROM p{rounds}), 6) AS rank FROM p{rounds}"""


def converged_rank_sql(rounds, tol, source=None):
    """PageRank by passing on changes larger than ``tol``; ``rounds`` must be enough to fall silent."""
    first = "0.15" if source is None else f"CASE WHEN id = {source} THEN 1.0 ELSE 0.0 END"
    total = "(SELECT count(*) FROM vertices)" if source is None else "1.0"
    steps = [f"p0 AS MATERIALIZED (SELECT id, {first}::DOUBLE AS r, {first}::DOUBLE AS delta FROM vertices)"]
    for k in range(1, rounds + 1):
        steps.append(
            f"""p{k} AS MATERIALIZED (SELECT p.id, p.r + 0.85 * coalesce(m.s, 0) AS r, 0.85 * coalesce(m.s, 0) AS delta
                FROM p{k - 1} p LEFT JOIN (
                  SELECT s.dst, sum(q.delta * s.share) AS s FROM p{k - 1} q JOIN shares s ON s.src = q.id
                  WHERE q.delta > {tol} GROUP BY s.dst) m ON m.dst = p.id)"""
        )
    return f"""{RANK_SQL}, {', '.join(steps)}
        SELECT id, round(r * {total} / (SELECT sum(r) FROM p{rounds}), 6) AS rank FROM p{rounds}"""


def rounded(ranks):
    return ranks.select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_static", fixed_rank_sql(10))
def pagerank_static(spark, d):
    return rounded(PR.pagerank(edges_of(spark, d), iterations=10))


@query("pagerank_personalized", fixed_rank_sql(10, source=5))
def pagerank_personalized(spark, d):
    return rounded(PR.pagerank(edges_of(spark, d), iterations=10, source=5))


MANY_SOURCES = (1, 2, 3, 5, 7)


@query(
    "pagerank_many_sources",
    " UNION ALL ".join(f"SELECT {s}::BIGINT AS source, id, rank FROM ({fixed_rank_sql(10, source=s)}) WHERE rank > 0" for s in MANY_SOURCES),
)
def pagerank_many_sources(spark, d):
    """Ranks as seen from each of five suppliers, all in one run; ranks that are printed as 0 are left out."""
    edges = edges_of(spark, d)
    sources = edges.select(F.col("src").alias("id")).where(F.col("id").isin(*MANY_SOURCES))
    ranks = PR.pagerank_many(edges, sources, iterations=10)
    return ranks.select("source", "id", F.round("rank", 6).alias("rank")).where("rank > 0")


@query("pagerank_converged", converged_rank_sql(16, 0.0001))
def pagerank_converged(spark, d):
    return rounded(PR.pagerank_until(edges_of(spark, d), tol=0.0001))


@query("pagerank_converged_personalized", converged_rank_sql(16, 0.0001, source=5))
def pagerank_converged_personalized(spark, d):
    return rounded(PR.pagerank_until(edges_of(spark, d), tol=0.0001, source=5))


@query(
    "pagerank_names",
    f"""SELECT s_name AS name, rank FROM ({fixed_rank_sql(5)}) JOIN supplier ON s_suppkey = id""",
)
def pagerank_names(spark, d):
    """Ranks with names; ids without a name or without an edge drop out."""
    ranks = rounded(PR.pagerank(edges_of(spark, d), iterations=5))
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return names.join(ranks, "id").select("name", "rank")
