"""Near-duplicate vectors by NN-descent: a neighbour graph, refined until it is quiet.

The graph starts from neighbours in random projections.  In each round every
node compares its neighbours, and those that have it for a neighbour, with each
other, and each keeps the best it has been told of.  Neighbours beyond the
threshold are confirmed in double precision and give links and components.
Where a node's list is full of links, its component is compared as a whole in
tiles, which counts its links without writing pairs down.  A sample of nodes
that have links is held against all others to audit the recall, hot components
apart; while it is low, projections, windows and lists are doubled, and if that
does not help there is no answer but an error.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.components import components
from weftline.session import staged

log = logging.getLogger(__name__)

THRESHOLD = 0.9
NEIGHBOURS = 10
# Projections the graph starts from, bits of their cells, and rows compared around each other.
TABLES, BITS, NEAR_ROWS = 6, 12, 128
MAX_ROUNDS, QUIET = 4, 0.002
# Half precision decides what is looked at; confirmed in double precision.
SLACK = 0.005
# Neighbours of a node compared at a time, and rows of a tile.
JOIN_ROWS, TILE_ROWS = 128, 512
# Sampled nodes at first and at most, of which so many should have a link; recall to reach.
AUDIT_ROWS, AUDIT_MOST, AUDIT_LINKED, AUDIT_RECALL = 256, 16384, 64, 0.95
# A component with more than this share of the nodes is audited apart from the others.
HOT_SHARE = 0.01
# Tables, windows and lists are doubled up to this factor while the recall is low.
MOST_GROWN = 8
EDGE = "id long, nbr long, sim float"


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit) with the unit vector as an array of double; null for a vector that links with nothing."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # Scaled by the largest component first, so that no square overflows or vanishes.
    most = F.array_max(F.transform("x", lambda v: F.abs(v)))
    good = F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(False)) & (F.coalesce("most", F.lit(0.0)) > 0)
    scaled = F.transform("x", lambda v: v / F.col("most"))
    norm = F.sqrt(F.aggregate("y", F.lit(0.0), lambda a, v: a + v * v))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).withColumn("most", most).withColumn(
        "y", F.when(good, scaled)).withColumn("norm", norm).select(
        "vec_id", F.transform("y", lambda v: v / F.col("norm")).alias("unit"))


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1) if len(column) else np.zeros((0, 0), kind)


def edge_batch(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float32())], ["id", "nbr", "sim"])


def packed_batches(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Node rows with the unit vector in double and in half precision; missing components are 0."""
    for batch in batches:
        full = np.zeros((batch.num_rows, width))
        for row, unit in zip(full, batch.column("unit").to_pylist()):
            row[:len(unit)] = unit
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("times"), pa.array([r.tobytes() for r in full], pa.binary()),
             pa.array([r.tobytes() for r in full.astype(np.float16)], pa.binary())], ["id", "times", "unit", "half"])


def cell_batches(batches: Iterable[pa.RecordBatch], width: int, tables: int = TABLES, bits: int = BITS) -> Iterator[pa.RecordBatch]:
    """(part, cell, along, id, half): each node once for every projection table."""
    rng = np.random.default_rng(7)
    planes = rng.normal(size=(tables, width, bits + 1)).astype(np.float32)
    for batch in batches:
        half = matrix(batch.column("half"), np.float16).astype(np.float32)
        for table in range(tables if len(half) else 0):
            at = half @ planes[table]
            cell = ((at[:, :bits] > 0) @ (1 << np.arange(bits))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cell), table, np.int32)), pa.array(cell), pa.array(at[:, bits]), batch.column("id"), batch.column("half")],
                ["part", "cell", "along", "id", "half"])


def near_batches(batches: Iterable[pa.RecordBatch], keep: int, across: float | None, near_rows: int = NEAR_ROWS) -> Iterator[pa.RecordBatch]:
    """Neighbours within runs of rows; each run reaches half into the one before.

    With ``across``, pairs of that similarity in different components instead.
    """
    names = ["id", "half"] + ["component"] * (across is not None)
    before = None
    for batch in batches:
        for at in range(0, batch.num_rows, near_rows):
            part = batch.slice(at, near_rows).select(names)
            table = pa.Table.from_batches([part] if before is None else [before, part]).combine_chunks()
            before = part.slice(max(0, part.num_rows - near_rows // 2))
            ids, x = table.column("id").to_numpy(), matrix(table.column("half"), np.float16).astype(np.float32)
            sims = x @ x.T
            sims[ids[:, None] == ids[None, :]] = -2
            if across is not None:
                group = table.column("component").to_numpy()
                a, b = np.nonzero((sims >= across) & (group[:, None] < group[None, :]))
                yield edge_batch(ids[a], ids[b], sims[a, b])
                continue
            n = min(keep, len(ids) - 1)
            if n < 1:
                continue
            best = np.argpartition(-sims, n - 1, axis=1)[:, :n]
            rows = np.repeat(np.arange(len(ids)), n)
            found = sims[rows, best.ravel()]
            ok = found > -2
            yield edge_batch(ids[rows[ok]], ids[best.ravel()[ok]], found[ok])


def local_joins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that share a neighbour, told to those for which they beat the end of their list.

    Rows (to, who, least, half) come in order of ``to``; the neighbours of a
    node are compared ``JOIN_ROWS`` at a time.
    """
    for batch in batches:
        to, who = batch.column("to").to_numpy(), batch.column("who").to_numpy()
        least, x = batch.column("least").to_numpy(), matrix(batch.column("half"), np.float16).astype(np.float32)
        cuts = [0, *(np.flatnonzero(np.diff(to)) + 1), len(to)]
        out: list[tuple] = []
        for start, end in zip(cuts, cuts[1:]):
            for at in range(start, end, JOIN_ROWS):
                stop = min(end, at + JOIN_ROWS)
                if stop - at < 2:
                    continue
                sims = x[at:stop] @ x[at:stop].T
                np.fill_diagonal(sims, -2)
                a, b = np.nonzero(sims > least[at:stop, None])
                out.append((who[at + a], who[at + b], sims[a, b]))
        if out:
            yield edge_batch(*(np.concatenate(c) for c in zip(*out)))


def linked_batches(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose cosine in double precision reaches the threshold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cosine = np.einsum("ij,ij->i", matrix(batch.column("ua"), np.float64), matrix(batch.column("ub"), np.float64))
        yield batch.select(["a", "b", "ta", "tb"]).filter(pa.array(cosine >= threshold))


def tile_batches(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(id, n): links of each row of a tile pair; rows (component, i, j, side, id, times, unit) come in order."""
    def counted(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        ids, times, side = (table.column(c).to_numpy() for c in ("id", "times", "side"))
        x = matrix(table.column("unit"), np.float64)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        n = np.zeros(len(ids), np.int64)
        if len(right):
            near = x[left] @ x[right].T >= threshold
            n[left], n[right] = near @ times[right], near.T @ times[left]
        else:
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            n = near @ times
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n, pa.int64())], ["id", "n"])

    rows: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("component", "i", "j")], 1)
        if not len(keys):
            continue
        cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(1)) + 1), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            now = tuple(keys[start])
            if now != key and rows:
                yield counted(rows)
                rows = []
            key = now
            rows.append(batch.slice(start, end - start))
    if rows:
        yield counted(rows)


def kept_best(edges: DataFrame, keep: int) -> DataFrame:
    best = edges.groupBy("id", "nbr").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(W.partitionBy("id").orderBy(F.desc("sim"), "nbr"))
    return best.withColumn("place", place).where(F.col("place") <= keep).select("id", "nbr", "sim")


def cells(nodes: DataFrame, width: int, tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """Nodes of each table in order of cell and place in it; ranges are cut by size, so no cell is too large for a task."""
    dealt = nodes.mapInArrow(lambda x: cell_batches(x, width, tables, bits), "part int, cell int, along float, id long, half binary")
    return dealt.repartitionByRange("part", "cell", "along").sortWithinPartitions("part", "cell", "along")


def refined(edges: DataFrame, nodes: DataFrame, keep: int) -> DataFrame:
    """One round: neighbours of neighbours, both ways."""
    told = edges.select(F.col("id").alias("to"), F.col("nbr").alias("who"))
    told = told.unionByName(edges.select(F.col("nbr").alias("to"), F.col("id").alias("who"))).distinct()
    ends = edges.groupBy("id").agg(F.when(F.count(F.lit(1)) >= keep, F.min("sim")).otherwise(F.lit(-1.0)).cast("float").alias("least"))
    known = nodes.select("id", "half").join(ends, "id", "left").select(
        F.col("id").alias("who"), F.coalesce("least", F.lit(-1.0).cast("float")).alias("least"), "half")
    found = told.join(known, "who").select("to", "who", "least", "half").repartition("to").sortWithinPartitions("to").mapInArrow(local_joins, EDGE)
    return kept_best(edges.unionByName(found), keep)


def confirmed(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ta, tb): pairs beyond the threshold, with the number of equal vectors at both ends."""
    end = lambda side: nodes.select(F.col("id").alias(side), F.col("times").alias(f"t{side}"), F.col("unit").alias(f"u{side}"))
    return pairs.join(end("a"), "a").join(end("b"), "b").select("a", "b", "ta", "tb", "ua", "ub").mapInArrow(
        lambda x: linked_batches(x, threshold), "a long, b long, ta long, tb long")


def ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("id", "nbr").alias("a"), F.greatest("id", "nbr").alias("b")).distinct()


def tiled_links(members: DataFrame, threshold: float) -> DataFrame:
    """(id, n): links within whole components, from ``members`` (component, id, times, unit).

    A component of s nodes is cut into tiles; every two tiles meet in one task
    group of bounded size, and only counts come out.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("tiles"))
    cut = members.join(sizes, "component").withColumn("t", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    both = cut.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    i, j = F.least("t", "o"), F.greatest("t", "o")
    side = F.when(F.col("t") == i, 0).otherwise(1)
    rows = both.select("component", i.alias("i"), j.alias("j"), side.alias("side"), "id", "times", "unit")
    order = ["component", "i", "j"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        lambda x: tile_batches(x, threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def sampled_recall(pool: DataFrame, nodes: DataFrame, links: DataFrame, threshold: float, rows: int) -> float | None:
    """Mean share of the links of a node that are in ``links`` (id, n), over sampled nodes of ``pool`` that have one.

    The sample grows from ``rows`` until ``AUDIT_LINKED`` of its nodes have a
    link, it is the pool or it has ``AUDIT_MOST`` nodes; it meets all nodes.
    1 if no node of the pool has a link, None if only the sample has none.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(ids), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_ROWS):
                part = batch.slice(at, TILE_ROWS)
                near = x @ matrix(part.column("unit"), np.float64).T >= threshold
                n += (near & (ids[:, None] != part.column("id").to_numpy()[None, :])) @ part.column("times").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["id", "n"])

    while True:
        sample = pool.select("id", "unit").orderBy(F.xxhash64("id", F.lit(5)), "id").limit(rows).collect()
        if not sample:
            return 1.0
        ids, x = np.array([r["id"] for r in sample]), np.stack([np.frombuffer(r["unit"]) for r in sample])
        true = nodes.select("id", "times", "unit").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("true"))
        linked, recall = true.where(F.col("true") > 0).join(links, "id", "left").agg(
            F.count(F.lit(1)), F.avg(F.least("true", F.coalesce("n", F.lit(0))) / F.col("true"))).first()
        whole = len(sample) < rows
        if linked >= AUDIT_LINKED or whole or rows >= AUDIT_MOST:
            return recall if linked else 1.0 if whole else None
        rows = min(4 * rows, AUDIT_MOST)


def audited(nodes: DataFrame, links: DataFrame, groups: DataFrame, threshold: float, rows: int) -> float | None:
    """The lower recall of hot components and of all other nodes; None if no sampled node has a link.

    The members of a hot component are counted in tiles and would hide what
    the others lose.
    """
    least = HOT_SHARE * nodes.count()
    hot = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > least).select("component")
    members = staged(groups.join(hot, "component", "left_semi").select("id"), "hot")
    pools = [nodes.join(members, "id", "left_anti"), nodes.join(members, "id", "left_semi")]
    found = [r for r in (sampled_recall(pool, nodes, links, threshold, rows) for pool in pools) if r is not None]
    return min(found) if len(found) == len(pools) else None if min(found, default=1.0) >= AUDIT_RECALL else min(found)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding); other columns are not read.

    Vectors link at a cosine of ``threshold`` or more.  A vector that is null,
    zero, empty or holds null or non-finite components links with nothing.
    Equal vectors are one node and link with each other; rows that share id
    and vector count once as a partner and each get their row.  Different
    vectors of one id are different nodes, each with its own row and links.  Components
    missing at the end count as 0.  A null id takes part without being anyone's
    component and is never kept.  An empty table gives an empty one.  A recall
    below ``AUDIT_RECALL`` that growing does not mend is an error.
    """
    units = staged(unit_vectors(vectors), "units")
    good = units.where(F.col("unit").isNotNull())
    width = good.agg(F.max(F.size("unit"))).first()[0]
    if width is None:
        return units.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.col("vec_id").isNotNull().alias("kept"))
    # A node is a class of equal vectors with a number of its own: an id may have several vectors.
    classes = staged(good.where(F.col("vec_id").isNotNull()).distinct().groupBy("unit").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("times")).withColumn("id", F.monotonically_increasing_id()), "classes")
    nodes = staged(classes.select("id", "times", "unit").mapInArrow(
        lambda x: packed_batches(x, width), "id long, times long, unit binary, half binary"), "nodes")
    # Cells stay about as large as a window in a larger table.
    bits = min(30, max(BITS, (nodes.count() // NEAR_ROWS).bit_length()))
    keep, grown, edges = neighbours, 1, None
    while True:
        reach = NEAR_ROWS * grown
        near = staged(cells(nodes, width, TABLES * grown, bits), "cells")
        start = near.mapInArrow(lambda x: near_batches(x, keep, None, reach), EDGE)
        edges = staged(kept_best(start if edges is None else edges.unionByName(start), keep), "graph")
        weight = edges.agg(F.sum("sim")).first()[0] or 0.0
        for _ in range(MAX_ROUNDS):
            edges = staged(refined(edges, nodes, keep), "graph")
            now = edges.agg(F.sum("sim")).first()[0] or 0.0
            if now - weight <= QUIET * abs(now):
                break
            weight = now
        links = staged(confirmed(ordered(edges.where(F.col("sim") >= threshold - SLACK)), nodes, threshold), "links")
        groups = components(links)
        # Full lists hide further links: look for those between components, then count within them.
        labelled = near.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
        across = labelled.sortWithinPartitions("part", "cell", "along").mapInArrow(
            lambda x: near_batches(x, keep, threshold - SLACK, reach), EDGE)
        links = staged(links.unionByName(confirmed(ordered(across), nodes, threshold)).distinct(), "links")
        groups = components(links)
        full = edges.where(F.col("sim") >= threshold - SLACK).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= keep)
        whole = groups.join(full.select("id"), "id", "left_semi").select("component").distinct()
        members = groups.join(whole, "component", "left_semi").join(nodes.select("id", "times", "unit"), "id")
        tiled = tiled_links(members, threshold)
        counted = links.select(F.col("a").alias("id"), F.col("tb").alias("n")).unionByName(
            links.select(F.col("b").alias("id"), F.col("ta").alias("n"))).groupBy("id").agg(F.sum("n").alias("n"))
        n = staged(tiled.unionByName(counted.join(tiled.select("id"), "id", "left_anti")), "counts")
        recall = audited(nodes, n, groups, threshold, AUDIT_ROWS)
        if recall is None:
            log.warning("near_duplicates: none of %d sampled vectors has a link, so the recall is not known", AUDIT_MOST)
        if recall is None or recall >= AUDIT_RECALL:
            break
        if grown >= MOST_GROWN:
            raise RuntimeError(f"near_duplicates: recall {recall:.3f} of sampled vectors, less than {AUDIT_RECALL}, with {keep} neighbours")
        keep, grown = 2 * keep, 2 * grown
    # The least id of each component's vectors; alone, a class has its own.
    leasts = groups.join(classes.select("id", "least"), "id").groupBy("component").agg(F.min("least").alias("first"))
    named = groups.join(leasts, "component").select("id", "first")
    answer = classes.join(n, "id", "left").join(named, "id", "left").select(
        "unit", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("first", "least").alias("component"))
    rows = units.join(answer, "unit", "left")
    component: Column = F.coalesce("component", "vec_id")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                       F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
