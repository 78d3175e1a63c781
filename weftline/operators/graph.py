"""Property graphs as two frames: vertices ``(id, ...)`` and edges ``(src, dst, ...)``.

Parallel edges are kept.  Vertices are unique by id, so in every join below
only the edge side can have hot keys; its groups split under AQE.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.relational import broadcast_if_small
from weftline.session import cut_lineage, staged


# Edges per partition of a laid-out graph: some tens of megabytes.
ROWS_PER_PARTITION = 2_000_000


def edge_ids(edges: DataFrame) -> DataFrame:
    """Distinct vertex ids that occur in edges."""
    ends = F.explode(F.array("src", "dst"))
    return edges.select(ends.alias("id")).distinct()


def with_edge_vertices(vertices: DataFrame, edges: DataFrame, default: dict[str, Column]) -> DataFrame:
    """Vertices plus those that only edges mention, which get the default attributes."""
    extra = edge_ids(edges).join(vertices.select("id"), "id", "left_anti")
    attributes = [default[c].alias(c) for c in vertices.columns if c != "id"]
    return vertices.unionByName(extra.select("id", *attributes))


def _prefixed(vertices: DataFrame, end: str) -> DataFrame:
    return vertices.select(*[F.col(c).alias(end if c == "id" else f"{end}_{c}") for c in vertices.columns])


def triplets(vertices: DataFrame, edges: DataFrame, fields: str = "both", missing: str = "default") -> DataFrame:
    """Edges with the attributes of the source, the destination or both ends.

    No edge is lost: an end that is not among the vertices has null attributes,
    or with ``missing="error"`` fails the job.
    """
    if missing not in ("default", "error"):
        raise ValueError("missing must be 'default' or 'error'")
    view = edges
    for end in ("src", "dst"):
        if fields not in (end, "both"):
            continue
        if missing == "default":
            view = view.join(_prefixed(vertices, end), end, "left")
            continue
        view = view.join(_prefixed(vertices, end).withColumn("_known", F.lit(True)), end, "left")
        refused = F.raise_error(F.lit(f"an edge has a {end} that is not a vertex")).cast(dict(edges.dtypes)[end])
        view = view.withColumn(end, F.when(F.col("_known"), F.col(end)).otherwise(refused)).drop("_known")
    return view


def in_degrees(edges: DataFrame) -> DataFrame:
    """Vertices without incoming edges are absent; likewise below."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("degree"))


def out_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


def degrees(edges: DataFrame) -> DataFrame:
    """In, out and total degree of every vertex with an edge, from one shuffle."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        )
    )
    return ends.groupBy("id").agg(
        F.sum("i").alias("in_deg"), F.sum("o").alias("out_deg"), F.count("*").alias("degree")
    )


def enrich_degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices with both degrees; 0 where there is no edge."""
    found = degrees(edges).select("id", "in_deg", "out_deg")
    return vertices.join(found, "id", "left").fillna(0, ["in_deg", "out_deg"])


def subgraph(vertices: DataFrame, edges: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Kept vertices, and the edges with both ends kept."""
    kept = vertices.filter(keep)
    ids = kept.select("id")
    inner = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )
    return kept, inner.select(*edges.columns)


def aggregate_messages(
    vertices: DataFrame,
    edges: DataFrame,
    message: Column,
    merge: dict[str, Column],
    fields: str = "both",
    to: str = "dst",
    when: Column | None = None,
) -> DataFrame:
    """Send ``message`` along every edge and merge what a vertex receives.

    ``message`` and ``when`` may use edge columns and the ``src_``/``dst_``
    columns of the chosen ends; ``merge`` holds aggregates over ``msg``.
    Vertices that receive nothing are absent.
    """
    view = triplets(vertices, edges, fields)
    if when is not None:
        view = view.filter(when)
    sent = view.select(F.col(to).alias("id"), message.alias("msg"))
    return sent.groupBy("id").agg(*[agg.alias(name) for name, agg in merge.items()])


def highest(found: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Per kind of degree the vertex that has most; the lowest id among equals.

    ``kinds`` maps a label to a degree column; all are found in one pass.
    """
    best = {
        label: F.max(F.struct(F.col(column).alias("degree"), (-F.col("id")).alias("minus_id")))
        for label, column in kinds.items()
    }
    one = found.agg(*[value.alias(label) for label, value in best.items()])
    rows = [
        F.struct(
            F.lit(label).alias("kind"),
            (-F.col(f"{label}.minus_id")).alias("id"),
            F.col(f"{label}.degree").alias("degree"),
        )
        for label in kinds
    ]
    return one.select(F.inline(F.array(*rows)))


def layout(
    edges: DataFrame, rows_per_split: int = 1_000_000, degree: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Edges prepared for repeated joins on their source, and the source table.

    Returns the edges with a ``split`` column, hash-partitioned by
    ``(src, split)`` into as many partitions as their number asks for and
    persisted, and ``(id, out_deg, splits)``.  A source with more than
    ``rows_per_split`` edges is spread over several splits; its state row is
    repeated once per split when it sends.  The list of such sources has at
    most ``edges / rows_per_split`` rows.  ``degree`` is the aggregate used as
    out-degree, by default the number of rows.
    """
    stored = staged(edges, "edges")
    rows = F.count("*")
    sources = cut_lineage(
        stored.groupBy(F.col("src").alias("id")).agg(
            rows.alias("rows"),
            (rows if degree is None else degree).alias("out_deg"),
            F.ceil(rows / F.lit(rows_per_split)).cast("int").alias("splits"),
        )
    )
    large = sources.filter("splits > 1").select(F.col("id").alias("src"), "splits")
    # Row ids of a written table are the same in every attempt of a task, and
    # unlike a hash of the columns they also spread copies of one edge.
    numbered = stored.withColumn("_row", F.monotonically_increasing_id())
    slot = F.pmod(F.col("_row"), F.coalesce("splits", F.lit(1))).cast("int")
    spread = numbered.join(broadcast_if_small(large), "src", "left").select(*edges.columns, slot.alias("split"))
    total = sources.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    spark = edges.sparkSession
    if total <= ROWS_PER_PARTITION:
        # The state of a small graph is broadcast, so only the cores count.
        parts = spark.sparkContext.defaultParallelism
    else:
        # With fewer than the session's shuffle partitions a join would move the edges again.
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_PARTITION))
    # Sorted too, so that merge joins in later rounds neither move nor sort the edges.
    placed = spread.repartition(parts, "src", "split").sortWithinPartitions("src", "split")
    placed.persist(StorageLevel.MEMORY_AND_DISK)
    # The planner knows the partitioning of a cached adaptive plan only once it has run.
    placed.count()
    return placed, sources.select("id", "out_deg", "splits")
