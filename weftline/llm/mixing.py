"""Mixing sources to target weights, with DataFrame functions only.

The words of each source are packed into blocks of fixed length.  Every slot of
an output shard draws its source, so a shard's counts are multinomial; a last
part of the shards settles what the draws left open of each target.  The slots
of a source are numbered through and mapped to blocks by a pseudorandom
permutation of block numbers, once for every pass over the source; blocks are
joined by number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weftline.llm.common import text_or_empty, with_text, word_count
from weftline.session import at_most, staged

WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
BLOCK_WORDS = 32
SLOTS_PER_SHARD = 8192
# Groups in which a source's documents are placed side by side: no task orders a whole source.
GROUP_BITS = 10
# Up to so many sources are broadcast; beyond, the join shuffles.
BROADCAST_SOURCES = 50_000
# Shards are numbered through in groups of so many, so that no task orders all shards of a source.
SHARD_GROUP = 4096
# Cells of the unit line at least, by which a draw finds its source; beyond as many sources there are more.
CELLS = 4096
# Draws stop so many standard deviations short of a source's target; the rest is settled.
SHORT = 3.0
# Rounds of the permutation, and walks along its cycle before the rare long ones.
ROUNDS, WALKS = 4, 4
SEED = 11


@dataclass
class Mix:
    """``rows``: a row per document with its place; ``pieces``: what the mix takes, piece by piece."""

    rows: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """Target of every row of ``sizes`` (source, source_size, one row per source).

    Sources by code point, null last, take the weights in turn and share the
    sum of all sizes; none gets more than ``passes`` times its size, and what
    is over goes to the others by weight.  In order of size to weight, the
    level at which the caps are filled is the largest of the levels that
    assume the first k sources capped.  Adds ``src`` (from 0) and ``target``.
    The windows have one row per source.
    """
    named = sizes.withColumn("src", (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("src") % len(weights) + 1)
    capped = named.withColumn("weight", weight).withColumn("cap", F.col("source_size") * passes)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "src")
    before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing))
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    leveled = capped.withColumn("level", (F.sum("source_size").over(everything) - before) / after)
    return leveled.select("source", "src", "source_size", F.least(
        F.col("cap").cast("double"), F.max("level").over(everything) * F.col("weight")).alias("target"))


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of ``sized`` with ``src`` and ``start``, the place of their first word in their source."""
    known = F.broadcast(sources) if at_most(sources, BROADCAST_SOURCES) else sources
    group = F.shiftrightunsigned(F.xxhash64("doc_id", "h", F.lit(SEED)), 64 - GROUP_BITS)
    rows = sized.join(known, sized["source"].eqNullSafe(known["source"])).drop(known["source"]).withColumn("g", group)
    sums = rows.groupBy("src", "g").agg(F.sum("size").alias("group_size"))
    starts = sums.select("src", "g", F.coalesce(F.sum("group_size").over(
        W.partitionBy("src").orderBy("g").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("group_start"))
    within = F.coalesce(F.sum("size").over(
        W.partitionBy("src", "g").orderBy("doc_id", "h").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("within", within).join(starts, ["src", "g"]).withColumn(
        "start", F.col("group_start") + F.col("within")).drop("g", "group_start", "within")


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) drawn from the keys by a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(SEED)), 11) * (2.0**-53)


def shares(sources: DataFrame, block_words: int) -> DataFrame:
    """(src, blocks, wanted, aim, drawn, low, high): blocks that the mix wants of each source, and its part of the unit line.

    ``aim`` is how many of them the draws should give: short of all by a few
    standard deviations.  One row per source that has words.
    """
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    wanted = F.round(F.col("target") / F.col("source_size") * blocks).cast("long")
    aim = F.floor(F.greatest(F.col("wanted") - SHORT * F.sqrt("wanted"), F.lit(0.0))).cast("long")
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    upto = F.sum("aim").over(W.orderBy("src").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("aim").over(everything)
    return sources.where(F.col("source_size") > 0).select("src", blocks.alias("blocks"), wanted.alias("wanted")).where(
        F.col("wanted") > 0).withColumn("aim", aim).withColumn("drawn", total).withColumn("upto", upto).select(
        "src", "blocks", "wanted", "aim", "drawn", ((F.col("upto") - F.col("aim")) / F.greatest("drawn", F.lit(1))).alias("low"),
        F.when(F.col("upto") >= F.col("drawn"), 1.0).otherwise(F.col("upto") / F.greatest("drawn", F.lit(1))).alias("high"))


def drawn_slots(sources: DataFrame, block_words: int, slots_per_shard: int) -> DataFrame:
    """(src, blocks, shard, k): every slot of every shard, numbered through for each source.

    Each slot of the drawn shards is an independent draw from the sources'
    shares, so the counts of a shard are multinomial.  The draws stop short of
    the targets, and what is missing of a source's target fills further shards.
    So a source gets its target, or now and then a little more by chance.  A draw finds its source
    by the cell of the unit line it falls in; slots are numbered by sums over
    groups of shards, over the shards of a group, and within a shard.
    """
    spark = sources.sparkSession
    parts = staged(shares(sources, block_words), "mix-shares")
    count, total, drawn = parts.agg(F.count(F.lit(1)), F.sum("wanted"), F.max("drawn")).first()
    if not count:
        return spark.createDataFrame([], "src int, blocks long, shard long, k long")
    cells = max(CELLS, 2 * count)
    drawn_shards = -(-drawn // slots_per_shard)
    # Every cell with the sources that reach into it: at most one row for each cell and source more.
    reached = parts.where(F.col("aim") > 0).select("src", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))).alias("cell"))
    reached = F.broadcast(reached) if count <= BROADCAST_SOURCES else reached
    slots = spark.range(drawn).select((F.col("id") / slots_per_shard).cast("long").alias("shard"), "id", uniform(F.col("id")).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * cells)).join(reached, "cell").where(
        (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).select("src", "shard", "id")
    slots = staged(slots.withColumn("g", (F.col("shard") / SHARD_GROUP).cast("long")), "mix-draws")
    by_shard = slots.groupBy("src", "g", "shard").agg(F.count(F.lit(1)).alias("n"))
    by_group = by_shard.groupBy("src", "g").agg(F.sum("n").alias("group_n"))
    earlier = lambda column, of: F.coalesce(F.sum(column).over(of.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    firsts = by_shard.join(by_group.select("src", "g", earlier("group_n", W.partitionBy("src").orderBy("g")).alias("group_first")), ["src", "g"]).select(
        "src", "shard", (F.col("group_first") + earlier("n", W.partitionBy("src", "g").orderBy("shard"))).alias("first"))
    place = F.row_number().over(W.partitionBy("src", "shard").orderBy("id")) - 1
    numbered = slots.select("src", "shard", place.alias("place")).join(firsts, ["src", "shard"]).join(
        parts.select("src", "blocks"), "src").select("src", "blocks", "shard", (F.col("first") + F.col("place")).alias("k"))
    got = by_group.groupBy("src").agg(F.sum("group_n").alias("got"))
    missing = parts.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0))).where(F.col("wanted") > F.col("got"))
    # Long rows are dealt out as ranges of one shard's length before they are opened.
    starts = missing.select("src", "blocks", "got", "wanted", F.explode(F.sequence(
        F.col("got"), F.col("wanted") - 1, F.lit(slots_per_shard).cast("long"))).alias("at"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = starts.repartition(partitions, "src", "at").select("src", "blocks", F.explode(F.sequence(
        F.col("at"), F.least(F.col("at") + slots_per_shard, F.col("wanted")) - 1)).alias("k"))
    more = max(1, -(-(total - drawn) // slots_per_shard))
    settled = rest.select("src", "blocks", (F.lit(drawn_shards) + F.pmod(F.xxhash64("src", "k", F.lit(SEED)), F.lit(more))).cast("long").alias("shard"), "k")
    return numbered.unionByName(settled)


def scrambled(x: Column, key: Column, a: Column, b: Column) -> Column:
    """A permutation of the numbers below a * b that depends on the key.

    The number is a pair (below a, below b); in turn each half is shifted by a
    hash of the other, which can be undone, and so no two numbers meet.
    """
    start = F.struct(F.floor(x / b).alias("l"), (x % b).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        left = F.when(i % 2 == 0, F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], key, i), a), a)).otherwise(s["l"])
        right = F.when(i % 2 == 1, F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], key, i), b), b)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(2 * ROUNDS)]), start, turn, lambda s: s["l"] * b + s["r"])


def permuted(k: Column, src: Column, blocks: Column) -> Column:
    """Block of the k-th slot: every pass meets each block once, in a pseudorandom order of its own.

    Numbers below ``blocks`` are permuted in the next larger rectangle, walking
    on until the result is below ``blocks`` again, which keeps it a permutation.
    """
    key = F.xxhash64(src, F.floor(k / blocks), F.lit(SEED))
    a = F.ceil(F.sqrt(blocks)).cast("long")
    b = F.ceil(blocks / a).cast("long")

    def walk(x: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), x, lambda y, _: F.when(y < blocks, y).otherwise(scrambled(y, key, a, b)))

    near = walk(scrambled(k % blocks, key, a, b), F.lit(WALKS).cast("long"))
    # A cycle has at most the numbers beyond `blocks` outside.
    return F.when(near < blocks, near).otherwise(walk(near, a * b - blocks + 1))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES,
        block_words: int = BLOCK_WORDS, slots_per_shard: int = SLOTS_PER_SHARD) -> Mix:
    """Mix ``docs`` (doc_id, source, text); other columns are not read.

    ``rows`` has each input row with ``h`` (hash of its text), size, src,
    source_size, target and start.  ``pieces`` has a row for each stretch of a
    document in a drawn block: shard, src, block, turn (pass over the source),
    start of the document, and the words from ``low`` up to ``high`` of it.
    Shards and blocks follow from hashes alone, so reruns agree.  A null text
    has no words; rows without words take no part; a null source is a source
    of its own; repeated rows are mixed each; an empty table gives empty ones.
    """
    h = F.xxhash64(text_or_empty(), F.lit(SEED))
    sized = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"), h.alias("h"),
                               word_count(text_or_empty()).alias("size")), "mix-sizes")
    sources = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, passes), "mix-targets")
    rows = staged(placed(sized, sources), "mix-rows")
    k, src, blocks = F.col("k"), F.col("src"), F.col("blocks")
    slots = drawn_slots(sources, block_words, slots_per_shard).where(k < passes * blocks).select(
        "shard", "src", permuted(k, src, blocks).alias("block"), F.floor(k / blocks).cast("int").alias("turn"))
    end = F.col("start") + F.col("size")
    cut = rows.where(F.col("size") > 0).select("src", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words))).alias("block"))
    stretch = cut.select(
        "src", "block", "start",
        F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0)).cast("int").alias("low"),
        F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size")).cast("int").alias("high"))
    # Both sides grow with the words; the planner takes the slots for few rows and would broadcast them.
    return Mix(rows, slots.hint("merge").join(stretch, ["src", "block"]))


def taken_words(mixed: Mix) -> DataFrame:
    """Words the mix takes of every input row, repeats counted."""
    sums = mixed.pieces.groupBy("src", "start").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long")
    return mixed.rows.join(sums, ["src", "start"], "left").select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The mix as documents: for each pass a row with the words taken of a text, its white space kept.

    Columns are those of ``docs``; ``n_chars``, where there is one, is set anew.
    Equal rows share what any of them is given.
    """
    by_turn = mixed.pieces.groupBy("src", "start", "turn").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("cuts"))
    def same(h: str | Column) -> Column:
        return F.xxhash64(F.col("doc_id").cast("string"), F.col("source").cast("string"), h)

    plan = mixed.rows.where(F.col("size") > 0).select("src", "start", same("h").alias("row")).join(
        by_turn, ["src", "start"]).groupBy("row").agg(F.collect_list("cuts").alias("all_cuts"))
    # The row travels as one column, so none of its names can clash.
    keyed = docs.select(F.struct("*").alias("doc"), same(F.xxhash64(text_or_empty(), F.lit(SEED))).alias("row"))
    joined = keyed.dropDuplicates(["row"]).join(plan, "row")
    # Each word with the white space after it, so the pieces of a whole text join to that text.
    words = F.regexp_extract_all(F.col("doc")["text"], F.lit(r"(?:^[\x20\x09-\x0D]+)?[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    rows = joined.select("doc", words.alias("words"), F.explode("all_cuts").alias("cuts"))
    text = F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice("words", c["low"] + 1, c["high"] - c["low"]))), "")
    return rows.select(with_text(text, docs.schema).alias("doc")).select("doc.*")
