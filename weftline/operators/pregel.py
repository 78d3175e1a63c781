"""Vertex programs: rounds of messages along edges until nobody is active."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.graph import edge_ids, layout, with_edge_vertices
from weftline.operators.relational import broadcast_if_small
from weftline.session import cut_lineage


def senders(state: DataFrame) -> DataFrame:
    """State rows as ``src`` rows, repeated once per split of a large source."""
    repeated = state.select("*", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("split"))
    hidden = ("id", "split", "active", "splits")
    return repeated.select(
        F.col("id").alias("src"), "split",
        *[F.col(c).alias(f"src_{c}") for c in state.columns if c not in hidden],
    )


def pregel(
    vertices: DataFrame,
    edges: DataFrame,
    message: Column,
    merge: Column,
    update: dict[str, Column],
    when: Column | None = None,
    stays_active: Column | None = None,
    fields: str = "src",
    max_rounds: int | None = None,
    rows_per_split: int = 1_000_000,
    initial: dict[str, Column] | None = None,
    active: str = "src",
    to: str = "dst",
    unknown: dict[str, Column] | None = None,
    closed: bool = False,
) -> DataFrame:
    """Run a vertex program from the state in ``vertices`` (unique ``id``).

    Ends of edges that ``vertices`` does not list are vertices too, with the
    attributes in ``unknown`` and null for others.  ``closed`` says that there
    are none, which saves looking for them; an edge with such an end is then lost.

    Every round, each active vertex with edges sends ``message`` (over edge
    columns and ``src_*``, with ``fields="both"`` also ``dst_*``) along those
    edges where ``when`` holds.  The messages of a destination are reduced by
    ``merge`` (an aggregate over ``msg``).  A receiver gets the ``update``
    columns, expressions over its old state and ``msg``, and is active in the
    next round if ``stays_active`` holds, by default always.

    ``initial`` changes the state of every vertex before the first round, as
    a message to all would.  ``active`` tells which end of an edge must be
    active for it to carry a message: ``src``, ``dst``, ``either`` or
    ``both``.  Messages go ``to`` the ``dst`` or the ``src`` end.
    """
    if active not in ("src", "dst", "either", "both") or to not in ("src", "dst"):
        raise ValueError("active is one of src, dst, either, both, and to is src or dst")
    start = vertices if initial is None else vertices.select(
        *[initial[c].alias(c) if c in initial else F.col(c) for c in vertices.columns])
    placed, sources = layout(edges, rows_per_split)
    if not closed:
        kinds = dict(start.dtypes)
        extra = {c: (unknown or {}).get(c, F.lit(None)).cast(kinds[c]) for c in start.columns if c != "id"}
        start = with_edge_vertices(start, placed, extra)
    return run_rounds(start, placed, sources, message, merge, update, when, stays_active, fields, max_rounds, active, to)


def run_rounds(
    vertices: DataFrame,
    placed: DataFrame,
    sources: DataFrame,
    message: Column,
    merge: Column,
    update: dict[str, Column],
    when: Column | None = None,
    stays_active: Column | None = None,
    fields: str = "src",
    max_rounds: int | None = None,
    active: str = "src",
    to: str = "dst",
) -> DataFrame:
    """The rounds of :func:`pregel` over edges laid out beforehand; releases them.

    The state is checkpointed every round, which both bounds the plan and
    makes the loop survive lost executors; the driver sees one row per round.
    """
    attributes = [c for c in vertices.columns if c != "id"]
    ends_on = {"dst": F.col("dst_on"), "either": F.col("src_on") | F.col("dst_on"), "both": F.col("src_on") & F.col("dst_on")}
    try:
        state = cut_lineage(
            vertices.join(sources, "id", "left").select(
                *vertices.columns, "out_deg", "splits", F.lit(True).alias("active")
            )
        )
        rounds = 0
        while max_rounds is None or rounds < max_rounds:
            if active == "src":
                talking = state.filter("active AND splits IS NOT NULL")
                if talking.isEmpty():
                    break
            else:
                # Any source may be asked for its edges, so its state goes along with whether it is active.
                if state.filter("active").isEmpty():
                    break
                talking = state.filter("splits IS NOT NULL").withColumn("on", F.col("active"))
            view = placed.join(senders(talking), ["src", "split"])
            if fields == "both" or active != "src":
                ends = state.select(
                    F.col("id").alias("dst"), F.col("active").alias("dst_on"), *[F.col(c).alias(f"dst_{c}") for c in attributes])
                view = view.join(ends, "dst")
            if active != "src":
                view = view.filter(ends_on[active])
            if when is not None:
                view = view.filter(when)
            inbox = view.select(F.col(to).alias("id"), message.alias("msg")).groupBy("id").agg(merge.alias("msg"))
            got = F.col("msg").isNotNull()
            again = got if stays_active is None else got & stays_active
            state = cut_lineage(
                state.join(inbox, "id", "left").select(
                    "id",
                    *[F.when(got, update[c]).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in attributes],
                    "out_deg",
                    "splits",
                    again.alias("active"),
                )
            )
            rounds += 1
    finally:
        placed.unpersist()
    return state.select(*vertices.columns)


# Rounds that are planned as one job before the state is checkpointed and looked at.
ROUNDS_PER_JOB = 5


def shortest_paths(vertices: DataFrame, edges: DataFrame, source: int, weight: str = "weight", rows_per_split: int = 1_000_000) -> DataFrame:
    """``(id, dist)`` from one vertex over non-negative weights; infinity if out of reach.

    Of parallel edges only the lightest matters, so they are reduced first.  A
    loop of weight 0 on every vertex carries its distance to the next round, so
    a round is one join and one aggregate over a single reading of the state,
    and several rounds make a job.  Only vertices whose distance fell in the
    last round send along their other edges.  It is over when none did.
    """
    lightest = edges.where("src <> dst").groupBy("src", "dst").agg(F.min(weight).cast("double").alias("weight"))
    # Ends of edges that are not listed are vertices too.
    everyone = vertices.select("id").union(edge_ids(edges)).distinct()
    loops = everyone.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("weight"))
    placed, sources = layout(lightest.unionByName(loops), rows_per_split)
    large = broadcast_if_small(sources.where("splits > 1").select("id", "splits"))
    start = F.when(F.col("src") == source, F.lit(0.0)).otherwise(F.lit(float("inf")))
    try:
        # Loops are laid out already, so the first state needs no shuffle for them.
        state = cut_lineage(placed.where("src = dst").select(F.col("src").alias("id"), start.alias("dist"), (F.col("src") == source).alias("fell")))
        while not state.where("fell").isEmpty():
            for _ in range(ROUNDS_PER_JOB):
                known = state.join(large, "id", "left").withColumn("splits", F.coalesce("splits", F.lit(1)))
                loop = F.col("src") == F.col("dst")
                sent = placed.join(senders(known), ["src", "split"]).where(loop | F.col("src_fell"))
                best = sent.select(
                    F.col("dst").alias("id"), (F.col("src_dist") + F.col("weight")).alias("reach"), F.when(loop, F.col("src_dist")).alias("was"),
                ).groupBy("id").agg(F.min("reach").alias("dist"), F.min("was").alias("was"))
                state = best.select("id", "dist", (F.col("dist") < F.col("was")).alias("fell"))
            state = cut_lineage(state)
    finally:
        placed.unpersist()
    return state.select("id", "dist")
