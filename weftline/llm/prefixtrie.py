"""Conversation prefix trie: adaptive radix trees over fixed-width turn ids.

A turn (role, text) has a 16-byte id, a conversation is the string of its ids,
and equal conversations are one string with a count.  Strings are dealt out by
range and sorted, so a run of them is a stretch of the trie.  A task puts each
run into an adaptive radix tree: nodes grow from 4 to 16, 48 and 256 children,
and a chain of single children is one node with a prefix.  Only byte depths
that end a turn are trie nodes.  Subtrees inside a run are final; the paths to
its first and last string, which other runs may share, are joined afterwards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.session import at_most, staged

WIDTH = 16
# Bytes of keys in one tree, and of joined ids that are hashed at a time.
TREE_BYTES, CHUNK_BYTES = 1 << 20, 1 << 20
# The part of a key that decides on its range; keys are sorted in full within it.
RANGE_BYTES = 64 * WIDTH
BROADCAST_ROWS = 100_000
ROOT = hashlib.sha256(b"").digest()[:WIDTH]


class Node:
    """A radix tree node: bytes that all keys below share, children by their next byte, keys that end here."""

    __slots__ = ("prefix", "layout", "bytes", "kids", "count", "least")

    def __init__(self, prefix: bytes):
        self.prefix, self.layout, self.bytes, self.kids = prefix, 4, bytearray(), []
        self.count, self.least = 0, None

    def get(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.kids[byte]
        if self.layout == 48:
            place = self.bytes[byte]
            return self.kids[place - 1] if place else None
        place = bisect_left(self.bytes, byte)
        return self.kids[place] if place < len(self.bytes) and self.bytes[place] == byte else None

    def put(self, byte: int, kid: Node) -> None:
        """Set a child; a full node takes the next larger layout first."""
        if self.layout <= 16:
            place = bisect_left(self.bytes, byte)
            if place < len(self.bytes) and self.bytes[place] == byte:
                self.kids[place] = kid
                return
            if len(self.kids) < self.layout:
                self.bytes.insert(place, byte)
                self.kids.insert(place, kid)
                return
            if self.layout == 4:
                self.layout = 16
            else:
                index = bytearray(256)
                for i, b in enumerate(self.bytes):
                    index[b] = i + 1
                self.layout, self.bytes = 48, index
            self.put(byte, kid)
        elif self.layout == 48:
            if self.bytes[byte]:
                self.kids[self.bytes[byte] - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.bytes[byte] = len(self.kids)
            else:
                self.kids = [self.kids[i - 1] if i else None for i in self.bytes]
                self.layout, self.bytes = 256, bytearray()
                self.put(byte, kid)
        else:
            self.kids[byte] = kid

    def children(self) -> list[tuple[int, Node]]:
        """Children in the order of their bytes."""
        if self.layout == 256:
            return [(b, kid) for b, kid in enumerate(self.kids) if kid is not None]
        if self.layout == 48:
            return [(b, self.kids[i - 1]) for b, i in enumerate(self.bytes) if i]
        return list(zip(self.bytes, self.kids))


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    return next(i for i in range(most) if a[i] != b[i])


def insert(root: Node, key: bytes, count: int, least: int) -> None:
    """Put a key into the tree below ``root``, whose prefix is empty; equal keys are added up."""
    above, node, at = None, root, 0
    while True:
        prefix = node.prefix
        same = shared(prefix, key[at:at + len(prefix)])
        if same < len(prefix):
            upper = Node(prefix[:same])
            node.prefix = prefix[same + 1:]
            upper.put(prefix[same], node)
            above.put(key[at - 1], upper)
            node = upper
        at += same
        if at == len(key):
            node.least = least if node.least is None else min(node.least, least)
            node.count += count
            return
        kid = node.get(key[at])
        if kid is None:
            kid = Node(key[at + 1:])
            kid.count, kid.least = count, least
            node.put(key[at], kid)
            return
        above, node, at = node, kid, at + 1


def prefix_digests(key: bytes) -> list[bytes]:
    """Digest of each turn-aligned beginning, the empty one first."""
    state, found = hashlib.sha256(), [ROOT]
    for i in range(0, len(key), WIDTH):
        state.update(key[i:i + WIDTH])
        found.append(state.digest()[:WIDTH])
    return found


class Stretch:
    """Trie nodes of one run of keys, in depth-first order, with what is below them in this run.

    ``kids``, ``leaves`` and ``saved`` leave open nodes (on the paths to the
    first and last key) out; these are joined between runs.
    """

    def __init__(self, keys: list[bytes], counts: list[int], leasts: list[int], chars: dict[bytes, int]):
        root = Node(b"")
        for key, count, least in zip(keys, counts, leasts):
            insert(root, key, count, least)
        self.left, self.right = prefix_digests(keys[0]), prefix_digests(keys[-1])
        self.open = {*self.left, *self.right}
        self.digest, self.parent, self.depth, self.chars = [ROOT], [-1], [0], [0]
        self.n, self.least = [0], [None]
        self.walk(root, chars)
        self.kids, self.leaves, self.saved = ([0] * len(self.digest) for _ in range(3))
        self.add_up()

    def walk(self, root: Node, chars: dict[bytes, int]) -> None:
        """Turn the radix tree's turn-aligned depths into trie nodes."""
        stack = [(root, b"", hashlib.sha256(), 0)]
        while stack:
            node, tail, state, here = stack.pop()
            path = tail + node.prefix
            aligned = len(path) - len(path) % WIDTH
            if aligned:
                state = state.copy()
            for i in range(0, aligned, WIDTH):
                turn = path[i:i + WIDTH]
                state.update(turn)
                self.digest.append(state.digest()[:WIDTH])
                self.parent.append(here)
                self.depth.append(self.depth[here] + 1)
                self.chars.append(chars[turn])
                self.n.append(0)
                self.least.append(None)
                here = len(self.digest) - 1
            self.n[here] += node.count
            self.least[here] = node.least if self.least[here] is None else self.least[here]
            rest = path[aligned:]
            stack.extend((kid, rest + bytes([b]), state, here) for b, kid in reversed(node.children()))

    def add_up(self) -> None:
        for i in range(len(self.digest) - 1, -1, -1):
            final = self.digest[i] not in self.open
            if final:
                self.leaves[i] += self.kids[i] == 0
                self.saved[i] += (self.n[i] - 1) * self.chars[i]
            up = self.parent[i]
            if up < 0:
                continue
            self.n[up] += self.n[i]
            if self.least[i] is not None and (self.least[up] is None or self.least[i] < self.least[up]):
                self.least[up] = self.least[i]
            if final:
                self.kids[up] += 1
                self.leaves[up] += self.leaves[i]
                self.saved[up] += self.saved[i]

    def rows(self) -> Iterator[tuple]:
        """Rows of NODES; ``chain`` is 0 for final nodes, 1 for the path to the first key, 2 for that to the last."""
        run, left = self.left[-1], set(self.left)
        for i, digest in enumerate(self.digest):
            up = self.parent[i]
            known = up >= 0 and self.digest[up] not in self.open
            row = (digest, None if up < 0 else self.digest[up], self.depth[i], self.chars[i], self.n[i], self.least[i],
                   self.kids[i], self.leaves[i], self.saved[i], self.least[up] if known else None, run)
            if digest not in self.open:
                yield (*row, 0, False)
                continue
            yield (*row, 1 if digest in left else 2, False)
            if digest in left and digest in self.right and self.left != self.right:
                # The second path passes here too; its sums are added, this node's own are not.
                yield (*row, 2, True)


NODES = ("digest binary, parent binary, depth long, chars long, n long, least long, kids long, leaves long, saved long, "
         "parent_least long, run binary, chain int, passing boolean")
ARROW_NODES = pa.schema([
    ("digest", pa.binary()), ("parent", pa.binary()), *[(name, pa.int64()) for name in
     ("depth", "chars", "n", "least", "kids", "leaves", "saved", "parent_least")],
    ("run", pa.binary()), ("chain", pa.int32()), ("passing", pa.bool_())])


def stretches(batches: Iterable[pa.RecordBatch], tree_bytes: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, count, least, chars) to rows of NODES, a tree for every ``tree_bytes`` of keys."""
    keys, counts, leasts, chars, size = [], [], [], {}, 0

    def closed():
        table = list(zip(*Stretch(keys, counts, leasts, chars).rows()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(table, ARROW_NODES.types)], schema=ARROW_NODES)

    for batch in batches:
        for key, count, least, sizes in zip(*(batch.column(i) for i in range(4))):
            key = key.as_py()
            keys.append(key)
            counts.append(count.as_py())
            leasts.append(least.as_py())
            chars.update(zip((key[i:i + WIDTH] for i in range(0, len(key), WIDTH)), sizes.values.to_pylist()))
            size += len(key) + WIDTH
            if size >= tree_bytes:
                yield closed()
                keys, counts, leasts, chars, size = [], [], [], {}, 0
    if keys:
        yield closed()


def joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (digest, conv_id) to (digest, first, text): ids joined by commas, in pieces of bounded size."""
    digest, first, texts, size = None, None, [], 0

    def piece():
        return pa.RecordBatch.from_pydict({"digest": pa.array([digest], pa.binary()), "first": pa.array([first], pa.int64()),
                                           "text": pa.array([",".join(texts)])})

    for batch in batches:
        for d, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and (d != digest or size >= CHUNK_BYTES):
                yield piece()
                texts, size = [], 0
            if not texts:
                digest, first = d, c
            texts.append(str(c))
            size += len(texts[-1]) + 1
    if texts:
        yield piece()


def hashed_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by digest and first id to (digest, ends_sha256); a piece at a time is in memory."""
    digest, state = None, None

    def line(digests, hashes):
        return pa.RecordBatch.from_pydict({"digest": pa.array(digests, pa.binary()), "ends_sha256": pa.array(hashes, pa.string())})

    for batch in batches:
        digests, hashes = [], []
        for d, text in zip(batch.column(0), batch.column(2)):
            d = d.as_py()
            if d == digest:
                state.update(b",")
            else:
                if state is not None:
                    digests.append(digest)
                    hashes.append(state.hexdigest())
                digest, state = d, hashlib.sha256()
            state.update(text.as_buffer())
        yield line(digests, hashes)
    if state is not None:
        yield line([digest], [state.hexdigest()])


def turn_id(role: Column, text: Column) -> Column:
    """Hex of the 16-byte id of a turn."""
    return F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def numbered(turns: DataFrame) -> DataFrame:
    """(conv_id, place from 1, id, chars) of every turn of ``turns`` (conv_id, turn, role, text).

    A null turn comes first, ties go by the turn's id, repeated rows are turns
    of their own, a null role or text counts as empty, and rows without a
    conv_id belong to no conversation.  Other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", turn_id(role, text).alias("id"), F.length(text).cast("long").alias("chars"),
    ).withColumn("place", F.row_number().over(
        Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "id")).cast("long")).drop("turn")


def rebuilt(turns: DataFrame, lead: Column, base: Column, most: int) -> DataFrame:
    """Turns of conversations that begin with the first turns of another one.

    ``turns`` is as :func:`numbered` gives it.  Conversation c has the first
    ``lead`` (of c, at most ``most``) turns of conversation ``base`` (of c), as
    far as there are any, and then its own after its first ``lead``.  A row of
    place 0 without an id stands for each conversation, turns or none.
    """
    first = turns.where(F.col("place") <= most).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "chars"))).alias("first"))
    convs = turns.where(F.col("place") == 1).select("conv_id", lead.alias("lead"), base.alias("base"))
    heads = convs.join(first.select(F.col("conv_id").alias("base"), "first"), "base", "left")
    none = F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit(None).cast("string").alias("id"), F.lit(0).cast("long").alias("chars")))
    taken = F.filter(F.coalesce("first", F.slice(none, 1, 0)), lambda t: t["place"] <= F.col("lead"))
    heads = heads.select("conv_id", F.explode(F.concat(none, taken)).alias("t")).select("conv_id", "t.*")
    return heads.unionByName(turns.where(F.col("place") > lead).select("conv_id", "place", "id", "chars"))


def strings(turns: DataFrame) -> DataFrame:
    """(conv_id, key, digest, chars) of every conversation: its turn ids as one string."""
    lists = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "chars"))).alias("t"))
    lists = lists.select("conv_id", F.filter("t", lambda x: x["id"].isNotNull()).alias("t"))
    keyed = lists.select("conv_id", F.unhex(F.array_join("t.id", "")).alias("key"), F.col("t.chars").alias("chars"))
    return keyed.select("conv_id", "key", "chars", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH)).alias("digest"))


def joined_paths(nodes: DataFrame) -> DataFrame:
    """Open nodes of all runs put together: (digest, parent, depth, n, least, kids, leaves, saved).

    A node is counted by the first run that has it.  Going up a run's path,
    counts are running sums, so every node gets what is below it in that run.
    """
    paths = nodes.where(F.col("chain") > 0)
    whole = paths.where(~F.col("passing")).groupBy("digest").agg(
        F.min("run").alias("owner"), F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("chars").alias("chars"),
        F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("kids").alias("kids"))
    whole = whole.join(whole.groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("more")), "digest", "left")
    whole = staged(whole.select("digest", "owner", "parent", "depth", "chars", "n", "least",
                                (F.col("kids") + F.coalesce("more", F.lit(0))).alias("kids")), "trie-paths")
    own = ~F.col("passing") & (F.col("run") == F.col("owner"))
    values = paths.select("digest", "run", "chain", "passing", "depth", "leaves", "saved").join(
        whole.select("digest", "owner", "chars", "n", "kids"), "digest")
    values = values.select(
        "digest", "run", "chain", "depth",
        (F.when(F.col("passing"), 0).otherwise(F.col("leaves")) + F.when(own & (F.col("kids") == 0), 1).otherwise(0)).alias("leaves"),
        (F.when(F.col("passing"), 0).otherwise(F.col("saved"))
         + F.when(own, (F.col("n") - 1) * F.col("chars")).otherwise(0)).alias("saved"))
    upwards = Window.partitionBy("run", "chain").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = values.select("digest", F.sum("leaves").over(upwards).alias("leaves"), F.sum("saved").over(upwards).alias("saved"))
    sums = sums.groupBy("digest").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return whole.select("digest", "parent", "depth", "n", "least", "kids").join(sums, "digest")


def trie(turns: DataFrame, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """One row per trie node over the conversations in ``turns`` (conv_id, place, id, chars).

    Columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (over the subtree: members less one, times the code
    points of the last text) and ends_sha256 (of the ids of conversations that
    end here, ascending, joined by commas).  Rows without an id only tell that
    there is such a conversation.  No conversations give no rows.

    Equal conversations are counted before they are dealt out, so no group of
    copies and no common beginning is one task's work; only their joined ids
    run through one digest, a piece at a time.  A conversation's ids (16 bytes
    a turn) must fit in a task.
    """
    convs = staged(strings(turns), "trie-strings")
    distinct = convs.groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("key").alias("key"), F.first("chars").alias("chars"))
    ordered = distinct.select("key", "n", "least", "chars").repartitionByRange(
        F.substring("key", 1, RANGE_BYTES)).sortWithinPartitions("key")
    nodes = staged(ordered.mapInArrow(lambda batches: stretches(batches, tree_bytes), NODES), "trie-nodes")
    pieces = convs.select("digest", "conv_id").repartitionByRange("digest", "conv_id").sortWithinPartitions(
        "digest", "conv_id").mapInArrow(joined_ids, "digest binary, first long, text string")
    ends = pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(
        hashed_ids, "digest binary, ends_sha256 string")

    paths = staged(joined_paths(nodes), "trie-joined")
    parents = paths.select(F.col("digest").alias("parent"), F.col("least").alias("parent_least"))
    parents = F.broadcast(parents) if at_most(parents, BROADCAST_ROWS) else parents
    columns = ["digest", "parent", "depth", "n", "least", "kids", "leaves", "saved"]
    final = nodes.where(F.col("chain") == 0)
    below = final.where(F.col("parent_least").isNull()).select(columns).unionByName(paths.select(columns)).join(parents, "parent", "left")
    every = final.where(F.col("parent_least").isNotNull()).select(*columns, "parent_least").unionByName(below)
    return every.join(ends, "digest", "left").select(
        F.col("least").alias("conv_id"), "depth", F.col("parent_least").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
