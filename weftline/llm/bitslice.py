"""Exact top-k inner products on a bit-sliced index.

Rows are dealt to blocks.  In a block, bit j of component d of all rows is one
bitmap.  The scores of a query are added up as bitmaps too: a component of the
query adds the slices of its dimension, shifted by each of its bits, through
full adders.  The top rows are then picked from the most significant slice of
the sum downward; rows that tie at the boundary go by id, and the scores of
the rows picked are read off the slices exactly.  Rows and queries with a
component too large for the index are scored in whole numbers, block by block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.session import bound_batches, staged

LEVELS = 256
BLOCK_ROWS, CHUNK_QUERIES = 4096, 64
# Components beyond this have no place in the index; their rows are scored without it.
LARGEST = 2**20
FOUND = "query_id long, vec_id long, score long"
BLOCK_SCHEMA = "block long, ids binary, low binary, bits binary, slices binary"


def stepped(vector: Column) -> Column:
    """floor(LEVELS * x) / LEVELS of each component, exact; null for a vector that takes no part."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # A double of 2^45 or more has no fraction that counts.
    step = lambda v: F.when(F.abs(v) < 2.0**45, F.floor(v * F.lit(float(LEVELS))).cast("double") / F.lit(float(LEVELS))).otherwise(v)
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(x, step))


def matrix(vectors: Iterable, width: int | None = None) -> np.ndarray:
    """Vectors as rows; a missing component counts as 0."""
    vectors = [np.asarray(v, np.int64) for v in vectors]
    width = max([width or 0, *map(len, vectors)])
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def sliced(frame: pd.DataFrame) -> pd.DataFrame:
    """The index of one block: rows in order of id, components less their smallest value, a bitmap for each bit."""
    frame = frame.sort_values("vec_id", kind="stable")
    values = matrix(frame["q"])
    low = values.min(0)
    values -= low
    bits = [int(x).bit_length() for x in values.max(0)]
    rows = -(-len(frame) // 64) * 64
    padded = np.zeros((rows, values.shape[1]), np.int64)
    padded[:len(frame)] = values
    slices = [np.packbits((padded[:, d] >> j & 1).astype(np.uint8), bitorder="little") for d in range(values.shape[1]) for j in range(bits[d])]
    return pd.DataFrame({
        "block": [frame["block"].iloc[0]], "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()], "low": [low.tobytes()],
        "bits": [np.array(bits, np.int64).tobytes()], "slices": [b"".join(s.tobytes() for s in slices)]})


class Adder:
    """Sum of weighted bitmaps as bitmaps: three of one weight become one of it and one of the next."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, weight: int, bitmap: np.ndarray) -> None:
        while True:
            while len(self.waiting) <= weight:
                self.waiting.append([])
            row = self.waiting[weight]
            row.append(bitmap)
            if len(row) < 3:
                return
            a, b, c = row
            half = a ^ b
            row[:] = [half ^ c]
            weight, bitmap = weight + 1, (a & b) | (c & half)

    def slices(self, shape: tuple[int, int]) -> list[np.ndarray]:
        weight = 0
        while weight < len(self.waiting):
            row = self.waiting[weight]
            if len(row) == 2:
                a, b = row
                row[:] = [a ^ b]
                self.add(weight + 1, a & b)
            weight += 1
        return [row[0] if row else np.zeros(shape, np.uint64) for row in self.waiting]


def top_rows(sums: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query, bitmaps of rows surely in the top k and of rows that tie for what is left."""
    sure, tied = np.zeros_like(rows), rows.copy()
    for s in reversed(sums):
        with_bit = tied & s
        n = np.bitwise_count(sure | with_bit).sum(1)
        many, few = (n > k)[:, None], (n <= k)[:, None]
        sure = np.where(few, sure | with_bit, sure)
        tied = np.where(many, with_bit, np.where((n == k)[:, None], np.uint64(0), tied & ~s))
    return sure, tied


def search(block, queries: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, row id, score) of the top k rows of a block for every query, its own row left out."""
    own = np.frombuffer(block.ids, np.int64)
    low, bits = np.frombuffer(block.low, np.int64), np.frombuffer(block.bits, np.int64)
    words = -(-len(own) // 64)
    slices = np.frombuffer(block.slices, np.uint64).reshape(-1, words)
    width = max(queries.shape[1], len(low))
    q = np.zeros((len(queries), width), np.int64)
    q[:, :queries.shape[1]] = queries
    q = q[:, :len(low)]
    # A negative component adds the complements of the slices; the difference is the same for all rows.
    base = q @ low + np.minimum(q, 0) @ ((1 << bits) - 1)
    adder, at = Adder(), 0
    for d, n in enumerate(bits):
        size = np.abs(q[:, d])
        flip = np.where(q[:, d] < 0, ~np.uint64(0), np.uint64(0))[:, None]
        used = [(b, np.where(size >> b & 1, ~np.uint64(0), np.uint64(0))[:, None]) for b in range(int(size.max(initial=0)).bit_length())]
        for j in range(n):
            signed = slices[at + j][None, :] ^ flip
            for b, mask in used:
                adder.add(j + b, signed & mask)
        at += n
    shape = (len(q), words)
    sums = adder.slices(shape)
    rows = np.zeros((len(q), words * 64), np.uint8)
    rows[:, :len(own)] = 1
    first, last = np.searchsorted(own, ids, "left"), np.searchsorted(own, ids, "right")
    for i, (a, b) in enumerate(zip(first, last)):
        rows[i, a:b] = 0
    open_rows = np.packbits(rows, axis=1, bitorder="little").view(np.uint64)
    sure, tied = (np.unpackbits(x.view(np.uint8), axis=1, bitorder="little") for x in top_rows(sums, open_rows, k))
    # Rows are in order of id, so the first of the tied are the right ones.
    room = k - sure.sum(1, dtype=np.int64)
    chosen = sure.astype(bool) | (tied.astype(bool) & (np.cumsum(tied, axis=1, dtype=np.int64) <= room[:, None]))
    place, row = np.nonzero(chosen)
    score = base[place]
    for w, s in enumerate(sums):
        score = score + ((s[place, row >> 6] >> (row & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << w)
    return place, own[row], score


def search_batches(frames: Iterable[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows in order: each block's index, then the chunks of queries that meet it."""
    block, at = None, None
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.chunk is None:
                block, at = row, (row.block, row.share)
                continue
            # No rows may have been dealt to a block.
            if at != (row.block, row.share):
                continue
            ids = np.array([r["vec_id"] for r in row.chunk], np.int64)
            place, own, score = search(block, matrix(r["q"] for r in row.chunk), ids, k)
            yield pd.DataFrame({"query_id": ids[place], "vec_id": own, "score": score})


def met(blocks: DataFrame, chunks: DataFrame, n_blocks: int, n_chunks: int) -> DataFrame:
    """For every block its index, then the chunks, in one task: an index travels once for a share of all chunks.

    Blocks are few for a small table, so each comes in several shares of the
    chunks; there are more of them than tasks, which evens out the tasks.
    """
    spark = blocks.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    shares = max(1, min(n_chunks, -(-4 * tasks // n_blocks)))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    first = blocks.withColumn("share", numbers(shares)).withColumn("chunk_no", F.lit(-1).cast("long"))
    asked = chunks.withColumn("share", F.col("chunk_no") % shares).withColumn("block", numbers(n_blocks))
    both = first.unionByName(asked, allowMissingColumns=True)
    return both.repartition(min(n_blocks * shares, tasks), "block", "share").sortWithinPartitions("block", "share", "chunk_no")


def whole(vectors: Iterable) -> list[list[int]]:
    """LEVELS * x in whole numbers of any size, from components of ``stepped``."""
    return [[int(c * LEVELS) if abs(c) < 2.0**45 else int(c) * LEVELS for c in v] for v in vectors]


def products(a: list[list[int]], b: list[list[int]]) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, exact; a missing component counts as 0."""
    width = max(map(len, [*a, *b]), default=0)
    most = [max((abs(c) for v in m for c in v), default=0) for m in (a, b)]
    kind = np.int64 if max(most[0] * most[1] * width, *most) < 2**63 else object
    x, y = (np.array([v + [0] * (width - len(v)) for v in m], kind).reshape(len(m), width) for m in (a, b))
    return x @ y.T if width else np.zeros((len(a), len(b)), np.int64)


def score_batches(frames: Iterable[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """The top k rows of a block for every query of a chunk, without an index."""
    for frame in frames:
        for pair in frame.itertuples(index=False):
            ids = [r["vec_id"] for r in pair.rows]
            scores = products(whole(r["x"] for r in pair.chunk), whole(r["x"] for r in pair.rows))
            out = []
            for asked, own in zip((r["vec_id"] for r in pair.chunk), scores.tolist()):
                best = heapq.nsmallest(k, ((-s, i) for s, i in zip(own, ids) if i != asked))
                out += [(asked, i, -s) for s, i in best]
            for asked, i, s in out:
                if not -2**63 <= s < 2**63:
                    raise OverflowError(f"the score of query {asked} and row {i} does not fit a long")
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(np.int64)


def dealt(n: int) -> Column:
    return F.pmod(F.xxhash64("vec_id", "x"), F.lit(n)).cast("long")


def scored(rows: DataFrame, n_rows: int, asked: DataFrame, n_asked: int, k: int, block_rows: int, chunk_queries: int) -> DataFrame:
    """(query_id, vec_id, score): the top k of every block of ``rows`` for all of ``asked``, scored one by one."""
    n_blocks, n_chunks = max(1, -(-n_rows // block_rows)), max(1, -(-n_asked // chunk_queries))
    listed = lambda frame, n, place, name: frame.groupBy(dealt(n).alias(place)).agg(F.collect_list(F.struct("vec_id", "x")).alias(name))
    chunks = listed(asked, n_chunks, "chunk_no", "chunk").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    pairs = chunks.join(listed(rows, n_blocks, "block", "rows"), "block")
    spread = pairs.repartition(max(1, min(n_blocks * n_chunks, 4 * n_chunks + n_blocks)), "block", "chunk_no")
    return spread.select("chunk", "rows").mapInPandas(lambda frames: score_batches(frames, k), FOUND)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` with the highest score for every row of ``queries``.

    Both have vec_id and embedding; other columns are not read.  The score is
    the inner product of floor(256 x); ties go to the smaller id, a query's
    own id is left out, and all are returned if there are fewer than ``k``.
    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without an id.  A component missing at the end counts as 0.
    Equal rows count once; an empty table gives an empty one.  Every block of
    rows meets every block of queries once; each pair gives at most ``k`` rows
    a query.  Rows with a component beyond 2^12 meet all queries, and such
    queries all rows, without the index.  A score that does not fit a long is
    an error.
    """
    bound_batches(vectors.sparkSession)
    rows, asked = staged(stepped_rows(vectors), "vectors"), staged(stepped_rows(queries), "queries")
    (n_in, n_out), (asked_in, asked_out) = counts(rows), counts(asked)
    n_blocks, n_chunks = max(1, -(-n_in // block_rows)), max(1, -(-asked_in // chunk_queries))
    indexed = lambda frame: frame.where("inside").select(
        "vec_id", "x", F.transform("x", lambda v: (v * F.lit(float(LEVELS))).cast("int")).alias("q"))
    blocks = indexed(rows).select("vec_id", "q", dealt(n_blocks).alias("block")).groupBy("block").applyInPandas(sliced, BLOCK_SCHEMA)
    chunks = indexed(asked).groupBy(dealt(n_chunks).alias("chunk_no")).agg(F.collect_list(F.struct("vec_id", "q")).alias("chunk"))
    found = met(blocks, chunks, n_blocks, n_chunks).select("block", "share", "ids", "low", "bits", "slices", "chunk").mapInPandas(lambda frames: search_batches(frames, k), FOUND)
    if n_out:
        found = found.unionByName(scored(rows.where("NOT inside"), n_out, asked, asked_in + asked_out, k, block_rows, chunk_queries))
    if asked_out:
        found = found.unionByName(scored(rows.where("inside"), n_in, asked.where("NOT inside"), asked_out, k, block_rows, chunk_queries))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def counts(rows: DataFrame) -> tuple[int, int]:
    """Rows that the index takes, and the others."""
    return tuple(rows.agg(F.count_if("inside"), F.count_if(~F.col("inside"))).first())


def stepped_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, inside) of the rows that take part; those not ``inside`` have no place in the index."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), stepped(F.col("embedding")).alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull()).distinct().withColumn(
        "inside", F.forall("x", lambda v: F.abs(v) <= F.lit(float(LARGEST // LEVELS))))
