"""Near-duplicates by MinHash: many universal hash minima, bands, verification, components.

Documents with equal shingle sets are one class from the start.  Classes that
share a band meet in its bucket.  A bucket is never paired up whole: its most
central member, the one that meets most others in all of its buckets, is
compared with the rest, which joins a group of near copies at about one
comparison a member.  Members of buckets that still hold several components
are then matched by their rarest shingles: similar sets share one of them, and
only pairs in different components are made.  So every link that matters for
the components is looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.common import gram_hashes, mixed, split_words, text_or_empty, text_slices, word_hashes
from weftline.llm.components import components
from weftline.session import staged

SHINGLE_WORDS, PERCENT = 5, 80
# A pair at 80 % shares no band once in 300,000 times, one at 85 % once in 50 million.
BANDS, BAND_ROWS = 24, 4
HASHES = BANDS * BAND_ROWS
# A signature may miss the similarity by so many standard deviations before a pair is let go.
DEVIATIONS = 5.0

_rng = np.random.default_rng(20240501)
FACTORS = _rng.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _rng.integers(0, 2**63, HASHES, np.uint64) * np.uint64(2)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Distinct shingles of each text as sorted hashes; fewer words are one shingle, none give none."""
    flat, counts = split_words(texts, lower=True)
    hashes = word_hashes(flat)
    grams = gram_hashes(hashes, words)
    sets = []
    for end, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
        start = end - n
        if n >= words:
            sets.append(np.unique(grams[start:end - words + 1]))
        else:
            sets.append(mixed(gram_hashes(hashes[start:end], n) + np.uint64(n)) if n else np.zeros(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of the universal hashes (a x + b) >> 32 over each set that is not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((flat * FACTORS[i] + SHIFTS[i]) >> np.uint64(32), starts)
    return out


SIGNED = "doc_id long, n_shingles long, f1 long, f2 long, signature binary"


def sign_batches(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        sets = shingle_sets(part.column("text"), words)
        full = [i for i, s in enumerate(sets) if len(s)]
        marks = np.zeros((len(sets), 2), np.int64)
        signed: list[bytes | None] = [None] * len(sets)
        if full:
            for i, row in zip(full, signatures([sets[i] for i in full])):
                signed[i] = row.tobytes()
                marks[i] = np.frombuffer(hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1]),
             pa.array(signed, pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "signature"])


def set_batches(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text"):
        sets = [s.tobytes() for s in shingle_sets(part.column("text"), words)]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["id", "shingles"])


def likely_batches(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least ``least`` places."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
        keep = (left == right).sum(1) >= least
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])


def linked_batches(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that are similar on their full sets."""
    for batch in batches:
        keep = []
        for left, right in zip(batch.column("xa"), batch.column("xb")):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
            common = np.count_nonzero(x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y)
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])


def confirmed(pairs: DataFrame, signed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked: by signature first, then on the full sets."""
    share = percent / 100
    least = HASHES * share - DEVIATIONS * (HASHES * share * (1 - share)) ** 0.5
    of = lambda df, column, side, name: df.select(F.col("id").alias(side), F.col(column).alias(name))
    likely = pairs.join(of(signed, "signature", "a", "sa"), "a").join(of(signed, "signature", "b", "sb"), "b").select(
        "a", "b", "sa", "sb").mapInArrow(lambda x: likely_batches(x, least), "a long, b long").distinct()
    return likely.join(of(sets, "shingles", "a", "xa"), "a").join(of(sets, "shingles", "b", "xb"), "b").select(
        "a", "b", "xa", "xb").mapInArrow(lambda x: linked_batches(x, percent), "a long, b long").distinct()


def similar_sizes(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar; unknown sizes can."""
    return F.col(a).isNull() | F.col(b).isNull() | (100 * F.least(a, b) >= percent * F.greatest(a, b))


def open_buckets(state: DataFrame) -> DataFrame:
    """Rows of ``state`` (key, component, ...) under keys with several components, with the largest as ``main``."""
    sizes = state.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"))
    still = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("members", "component"))["component"].alias("main")).where(
        F.col("parts") > 1).select("key", "main")
    return state.join(still, "key")


def shingle_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("shingles")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("id").to_numpy(), [len(x) for x in sets])), pa.array(np.concatenate(sets))], ["id", "key"])


def rare_first(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, id, n, component, place, short): the rarest shingles of each member of an open bucket.

    Of two similar sets the larger has one of its ``n - percent n / 100 + 1``
    rarest shingles in common with the other's, and the smaller one of its
    first ``short``: with more of them missing too few would be left.
    """
    ids = opened.select("id", "n", "component").distinct()
    each = sets.join(ids.select("id"), "id", "left_semi").mapInArrow(shingle_batches, "id long, key long")
    # Counts combine before the shuffle, and the join may split the rows of a shingle that many have.
    seen = each.join(each.groupBy("key").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") > 1), "key")
    # Those that nobody else has come first and only take up places.
    alone = F.col("n") - F.count(F.lit(1)).over(W.partitionBy("id"))
    place = F.row_number().over(W.partitionBy("id").orderBy("seen", "key"))
    n = F.col("n")
    ranked = seen.join(ids, "id").withColumn("place", place + F.coalesce(alone, F.lit(0)))
    return ranked.where(n.isNull() | (F.col("place") <= n - F.ceil(n * percent / 100) + 1)).select(
        "key", "id", "n", "component", "place", (n - F.ceil(n * (2 * percent) / (100 + percent)) + 1).alias("short"))


def cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members in different components that share one of their rarest shingles.

    Under each shingle those outside the largest component meet the others, so
    a shingle that a whole group has makes no pairs within the group.
    """
    opened = open_buckets(members)
    rest = opened.where(F.col("component") != F.col("main")).select(
        "key", *[F.col(c).alias(f"p_{c}") for c in ("id", "n", "component", "place", "short")])
    smaller = (F.col("p_n") < F.col("n")) | ((F.col("p_n") == F.col("n")) & (F.col("p_id") < F.col("id")))
    # The first shingle that two sets share leaves each at most what comes after it.
    room = 1 + F.least(F.col("p_n") - F.col("p_place"), F.col("n") - F.col("place"))
    near_front = F.col("p_n").isNull() | F.col("n").isNull() | (
        F.when(smaller, F.col("p_place") <= F.col("p_short")).otherwise(F.col("place") <= F.col("short"))
        & ((100 + percent) * room >= percent * (F.col("p_n") + F.col("n"))))
    return rest.join(opened, "key").where(
        (F.col("p_component") != F.col("component")) & similar_sizes("p_n", "n", percent) & near_front).select(
        F.least("p_id", "id").alias("a"), F.greatest("p_id", "id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    Words are lower-cased (A-Z) runs without white space; two documents are
    linked if 100 * common shingles >= percent * all their shingles.  Fewer
    words than a shingle has are one shingle; a null text or one without words
    has none and is linked with nothing.  Equal texts, repeated rows and rows
    that share an id are one node; component_id is the smallest id that links
    reach, and kept tells whether it is the row's own.  A null id takes the
    component of its equals and is never kept.  An empty table gives an empty
    one; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = staged(texts.mapInArrow(lambda x: sign_batches(x, words), SIGNED), "signatures")
    full = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = full.groupBy("f1", "f2").agg(
        F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n"))
    classes = staged(classes, "classes")
    key = F.explode(F.array(*[F.xxhash64(F.substring("signature", 4 * BAND_ROWS * i + 1, 4 * BAND_ROWS), F.lit(i)) for i in range(BANDS)]))
    # An id with several sets has no size, and is spared the tests that need one.
    sizes = classes.groupBy("id").agg(F.when(F.count(F.lit(1)) == 1, F.max("n")).alias("n"))
    members = classes.select("id", "signature").join(sizes, "id").select("id", "n", key.alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).where(
        F.col("low") != F.col("high")).select("key", "size")
    members = staged(members.join(shared, "key").distinct(), "buckets")
    weights = members.groupBy("id").agg(F.sum("size").alias("weight"))
    members = staged(members.select("key", "id", "n").join(weights, "id").select("key", "id", "weight", "n"), "buckets")
    needed = members.select("id").distinct()
    known = staged(classes.join(needed, "id", "left_semi").select("id", "signature"), "signatures-needed")
    # Joined in the same way at every size: the ids grow with the documents.
    sets = staged(texts.join(needed.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id", "left_semi").mapInArrow(
        lambda x: set_batches(x, words), "id long, shingles binary").where(F.length("shingles") > 0).distinct(), "sets")
    # Every member but the most central one is compared with that one.
    central = F.max(F.struct("weight", -F.col("id"), "n"))
    hubs = members.groupBy("key").agg(central.alias("hub")).select("key", (-F.col("hub")["col2"]).alias("hub"), F.col("hub")["n"].alias("hub_n"))
    met = members.join(hubs, "key").where(F.col("id") != F.col("hub"))
    sized = similar_sizes("hub_n", "n", percent)
    pairs = staged(met.where(sized).select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "pairs")
    groups = components(confirmed(pairs, known, sets, percent))
    # Buckets that still hold several components may hide links between them.
    state = met.select("key", "id", "n").join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    opened = staged(open_buckets(state), "open-buckets")
    if not opened.isEmpty():
        members = staged(rare_first(opened, sets, percent), "rare-shingles")
        links = confirmed(staged(cross_pairs(members, percent), "pairs"), known, sets, percent)
        groups = components(links.unionByName(groups.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    rows = signed.select("doc_id", "n_shingles", "f1", "f2").join(classes.select("f1", "f2", "id"), ["f1", "f2"], "left")
    rows = rows.join(groups, "id", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
