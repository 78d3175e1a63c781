"""PageRank for a fixed number of rounds or until changes are small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.graph import edge_ids, layout
from weftline.operators.pregel import run_rounds, senders
from weftline.operators.ranking import global_rank
from weftline.operators.relational import broadcast_if_small
from weftline.session import cut_lineage, release, staged

# Rounds that are planned as one job before the state is checkpointed.
ROUNDS_PER_JOB = 5
# Of many sources: as many as share a row of the state, and messages of a job.
SOURCES_PER_ROW, MESSAGES_PER_JOB = 8, 100_000_000


def _check(reset: float) -> None:
    if not 0 <= reset <= 1:
        raise ValueError("the reset probability must be between 0 and 1")


def _links(edges: DataFrame) -> DataFrame:
    """Parallel edges as one row with their number."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("n"))


def _scaled(ranks: DataFrame, personalized: bool) -> DataFrame:
    """Ranks that sum to the number of vertices, or to 1 when personalized."""
    total, count = ranks.agg(F.sum("rank"), F.count("*")).first()
    if not count:
        return ranks.select("id", "rank")
    if not total:
        raise ValueError("the source is not a vertex of the graph")
    factor = (1.0 if personalized else float(count)) / total
    return ranks.select("id", (F.col("rank") * F.lit(factor)).alias("rank"))


def _vertices(placed: DataFrame, vertices: DataFrame | None) -> DataFrame:
    """All ends of the edges and the given vertices."""
    ids = edge_ids(placed)
    return ids if vertices is None else ids.union(vertices.select("id")).distinct()


def pagerank(
    edges: DataFrame,
    iterations: int,
    reset: float = 0.15,
    source: int | None = None,
    vertices: DataFrame | None = None,
    rows_per_split: int = 1_000_000,
) -> DataFrame:
    """``(id, rank)`` after a fixed number of rounds.

    A round joins the ranks to the persisted edges and sums per destination.
    A zero row per vertex goes into the same sum, so vertices without
    incoming edges need no outer join and the old ranks are read only once.
    With ``source`` all reset mass goes to that vertex, which must be there.
    An empty graph gives no rows.
    """
    if iterations <= 0:
        raise ValueError("the number of iterations must be positive")
    _check(reset)
    personalized = source is not None
    placed, sources = layout(_links(edges), rows_per_split, F.sum("n"))
    try:
        base = cut_lineage(_vertices(placed, vertices).join(sources, "id", "left"))
        at_source = F.when(F.col("id") == F.lit(source), F.lit(1.0)).otherwise(F.lit(0.0))
        mass = at_source if personalized else F.lit(1.0)
        zero = base.select("id", F.lit(0.0).alias("c"), "out_deg", "splits")
        state = base.select("id", mass.alias("rank"), "out_deg", "splits")
        for round_no in range(1, iterations + 1):
            share = (F.col("rank") / F.col("out_deg")).alias("share")
            send = senders(state.filter("splits IS NOT NULL").select("id", share, "splits"))
            received = placed.join(send, ["src", "split"]).select(
                F.col("dst").alias("id"), (F.col("src_share") * F.col("n")).alias("c"),
                F.lit(None).cast("bigint").alias("out_deg"), F.lit(None).cast("int").alias("splits"),
            )
            summed = zero.unionByName(received).groupBy("id").agg(
                F.sum("c").alias("c"), F.max("out_deg").alias("out_deg"), F.max("splits").alias("splits")
            )
            state = summed.select("id", (reset * mass + (1 - reset) * F.col("c")).alias("rank"), "out_deg", "splits")
            if round_no % ROUNDS_PER_JOB == 0 or round_no == iterations:
                state = cut_lineage(state)
    finally:
        placed.unpersist()
    return _scaled(state.select("id", "rank"), personalized)


def pagerank_many(
    edges: DataFrame, sources: DataFrame, iterations: int, reset: float = 0.15, rows_per_split: int = 1_000_000,
    rows_per_job: int = MESSAGES_PER_JOB,
) -> DataFrame:
    """``(source, id, rank)``: personalized ranks for every vertex in ``sources`` (``id``) after a number of rounds.

    The state is keyed by a group of up to ``SOURCES_PER_ROW`` sources and the
    vertex, with a column for each source of the group, null where the source
    has not reached the vertex.  So an edge carries one message for a group, and
    a round is one join for all sources and grows with what they reach.  A round
    sends to its destinations slice by slice, about ``rows_per_job`` messages
    each; the disk holds the messages of one slice and the ranks of two rounds.
    Ranks of a source sum to 1; vertices it does not reach have no row.
    Each rank is the one that :func:`pagerank` gives for its source alone.
    """
    if iterations <= 0:
        raise ValueError("the number of iterations must be positive")
    _check(reset)
    placed, degrees = layout(_links(edges), rows_per_split, F.sum("n"))
    try:
        asked = cut_lineage(sources.select(F.col("id").alias("source")).distinct())
        missing = asked.join(edge_ids(placed).withColumnRenamed("id", "source"), "source", "left_anti")
        if not missing.isEmpty():
            raise ValueError("a source is not a vertex of the graph")
        ranked = global_rank(asked, ["source"])
        n_asked = ranked.count()
        width = min(SOURCES_PER_ROW, max(1, n_asked))
        groups = -(-n_asked // width)
        places = cut_lineage(ranked.select("source", F.floor(F.col("rank") / width).cast("long").alias("group"), (F.col("rank") % width).cast("int").alias("place")))
        slots = range(width)
        here = [F.col("place") == i for i in slots]
        home = F.element_at(F.array(*[F.lit(1 << i).cast("long") for i in slots]), F.col("place") + 1)
        # A bit for the source whose own vertex this is.
        own = places.select("group", F.col("source").alias("id"), home.alias("home"), *[F.when(h, F.lit(0.0)).alias(f"c{i}") for i, h in enumerate(here)])
        state = places.select("group", F.col("source").alias("id"), *[F.when(h, F.lit(1.0)).alias(f"r{i}") for i, h in enumerate(here)])
        slices = max(1, -(-placed.count() * groups // rows_per_job))
        mine = [F.pmod(F.xxhash64("id"), F.lit(slices)) == i for i in range(slices)]
        before: list[DataFrame] = []
        for _ in range(iterations):
            shares = [(F.col(f"r{i}") / F.col("out_deg")).alias(f"s{i}") for i in slots]
            send = senders(state.join(degrees, "id").select("id", "group", *shares, "splits"))
            received = placed.withColumnRenamed("dst", "id").join(send, ["src", "split"]).select(
                F.col("src_group").alias("group"), "id", F.lit(None).cast("long").alias("home"),
                *[(F.col(f"src_s{i}") * F.col("n")).alias(f"c{i}") for i in slots])
            parts = []
            for slice_no in range(slices):
                summed = own.unionByName(received).where(mine[slice_no]).groupBy("group", "id").agg(
                    F.bit_or("home").alias("home"), *[F.sum(f"c{i}").alias(f"c{i}") for i in slots])
                at_home = [F.when(F.col("home").bitwiseAND(F.lit(1 << i)) != 0, F.lit(float(reset))).otherwise(F.lit(0.0)) for i in slots]
                # Each slice is a job, whose shuffle files go with it.
                parts.append(staged(summed.select(
                    "group", "id", *[(at_home[i] + (1 - reset) * F.col(f"c{i}")).alias(f"r{i}") for i in slots]), "ranks"))
            state = reduce(DataFrame.unionByName, parts)
            for part in before:
                release(part)
            before = parts
    finally:
        placed.unpersist()
    ranks = state.select("group", "id", F.inline(F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"r{i}").alias("rank")) for i in slots]))).where("rank IS NOT NULL")
    ranks = ranks.join(broadcast_if_small(places), ["group", "place"]).select("source", "id", "rank")
    # One row per source.
    totals = ranks.groupBy("source").agg(F.sum("rank").alias("total"))
    return ranks.join(totals, "source").where(F.col("rank") > 0).select("source", "id", (F.col("rank") / F.col("total")).alias("rank"))


def pagerank_until(
    edges: DataFrame,
    tol: float,
    reset: float = 0.15,
    source: int | None = None,
    vertices: DataFrame | None = None,
    max_rounds: int | None = None,
    rows_per_split: int = 1_000_000,
) -> DataFrame:
    """``(id, rank)`` by passing on changes until none exceeds ``tol``.

    Only vertices that received something in the last round and changed by
    more than ``tol`` send, so the join shrinks with the active set.
    """
    if tol < 0:
        raise ValueError("the tolerance must not be negative")
    _check(reset)
    personalized = source is not None
    first = F.when(F.col("id") == F.lit(source), F.lit(1.0)).otherwise(F.lit(0.0)) if personalized else F.lit(float(reset))
    placed, sources = layout(_links(edges), rows_per_split, F.sum("n"))
    start = _vertices(placed, vertices).select("id", first.alias("rank"), first.alias("delta"))
    change = (1 - reset) * F.col("msg")
    ranks = run_rounds(
        start,
        placed,
        sources,
        message=F.col("src_delta") * F.col("n") / F.col("src_out_deg"),
        when=F.col("src_delta") > tol,
        merge=F.sum("msg"),
        update={"rank": F.col("rank") + change, "delta": change},
        max_rounds=max_rounds,
    )
    return _scaled(ranks.select("id", "rank"), personalized)
