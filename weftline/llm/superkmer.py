"""Removal of repeated word sequences through super-k-mers.

A window is ``k`` consecutive words.  Consecutive windows of a document with
the same minimiser (the least hash of their word groups) are cut out as one
string, a super-k-mer, and sent to the bucket of that minimiser.  Equal windows
have equal minimisers, so all of a sequence's windows meet in one bucket, where
they are sorted and compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import gram_hashes, mixed, split_words, text_or_empty, text_slices, texts_of, word_hashes
from weftline.session import staged

WINDOW_WORDS = 13
MINIMISER_WORDS = 3
SLICE_BYTES = 4 << 20
# Packed text that a bucket should get, and what a task sorts at once.
BUCKET_BYTES, SORT_BYTES = 16 << 20, 12 << 20
# A text is sent two to three times over, as windows that straddle two strings are in both.
OVERLAP = 3
SUB_BUCKETS = 256
NO_ID = 2**63 - 1
LEVEL = 3
SPANS = "doc_id long, h long, low int, high int"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, in log(width) passes."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - span:]) if width > span else out


def super_kmers(hashes: np.ndarray, counts: np.ndarray, k: int, m: int) -> tuple[np.ndarray, ...]:
    """(document place, first word, last word + 1, minimiser) of every super-k-mer; words are numbered over all documents."""
    starts = np.cumsum(counts) - counts
    none = np.zeros(0, np.int64)
    if len(hashes) < k:
        return none, none, none, np.zeros(0, np.uint64)
    least = sliding_least(gram_hashes(hashes, m), k - m + 1)
    # Windows that lie within one document.
    doc = np.repeat(np.arange(len(counts)), counts)[:len(least)]
    place = np.flatnonzero(np.arange(len(least)) + k <= (starts + counts)[doc])
    if not len(place):
        return none, none, none, np.zeros(0, np.uint64)
    cut = np.flatnonzero((np.diff(place) != 1) | (least[place][1:] != least[place][:-1]) | (np.diff(doc[place]) != 0)) + 1
    first, last = place[np.r_[0, cut]], place[np.r_[cut - 1, len(place) - 1]]
    return doc[first], first, last + k, least[first]


def joined_words(texts: pa.Array) -> tuple[bytes, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All texts with their words joined by one space, one after the other; the words, their starts and sizes, and words by text."""
    words, counts = split_words(texts)
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # Between the words of a text there is a space, between two texts there is none.
    full = np.cumsum(counts > 0) - 1
    starts = np.cumsum(sizes) - sizes + np.arange(len(sizes)) - np.repeat(full, counts)
    ends = np.r_[0, np.cumsum(counts)]
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)
    return "".join(pc.binary_join(lists, " ").to_pylist()).encode(), words, starts, sizes, counts


def packed(arrays: list[np.ndarray], text: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(
        [np.array([len(text), *(len(a.tobytes()) for a in arrays)], np.int64).tobytes(), *(a.tobytes() for a in arrays), text]))


def unpacked(data: bytes, kinds: list) -> tuple[list[np.ndarray], bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds) + 1)
    at, arrays = sizes.nbytes, []
    for kind, size in zip(kinds, sizes[1:]):
        arrays.append(np.frombuffer(raw[at:at + size], kind))
        at += size
    return arrays, raw[at:]


# Of a super-k-mer: document id, hash of its text, first word, sub-bucket.  Of a settled span: id, hash, first word, end.
KINDS = [np.int64, np.int64, np.int32, np.uint8, np.int64, np.int64, np.int32, np.int32]


def pack_batches(batches: Iterable[pa.RecordBatch], buckets: int, k: int, m: int) -> Iterator[pa.RecordBatch]:
    """(bucket, data): the super-k-mers of a run of documents for each bucket, each distinct string once.

    A string goes with the least id that has it here.  For documents with a
    larger id the run itself settles that all of its windows are repeats, so a
    passage that everybody has leaves a task once.
    """
    for part in text_slices(batches, "text", SLICE_BYTES):
        ids = pc.fill_null(part.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False)
        hashes = part.column("h").to_numpy(zero_copy_only=False)
        data, words, starts, sizes, counts = joined_words(part.column("text"))
        doc, first, end, least = super_kmers(word_hashes(words), counts, k, m)
        if not len(doc):
            continue
        low = (first - (np.cumsum(counts) - counts)[doc]).astype(np.int32)
        bucket = ((least >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)
        # In order of bucket and id, so that the first of equal strings is the one to send.
        order = np.lexsort((ids[doc], bucket))
        doc, low, first, end, bucket = doc[order], low[order], first[order], end[order], bucket[order]
        sub, long = (least[order] & np.uint64(255)).astype(np.uint8), end - first
        begin, stop = starts[first].tolist(), (starts[end - 1] + sizes[end - 1]).tolist()
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for a, b in zip(cuts, cuts[1:]):
            texts = [data[x:y] for x, y in zip(begin[a:b], stop[a:b])]
            at, settled = np.arange(a, b), np.zeros(0, np.int64)
            if len(set(texts)) < len(texts):
                holder: dict[bytes, int] = {}
                owner = np.fromiter((ids[doc[a + holder.setdefault(text, i)]] for i, text in enumerate(texts)), np.int64, b - a)
                sent = ids[doc[a:b]] == owner
                at, settled = at[sent], at[~sent]
                texts = [text for text, keep in zip(texts, sent.tolist()) if keep]
            arrays = [ids[doc[at]], hashes[doc[at]], low[at], sub[at],
                      ids[doc[settled]], hashes[doc[settled]], low[settled], (low[settled] + long[settled]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[a]], pa.int32()), pa.array([packed([x.astype(t) for x, t in zip(arrays, KINDS)], b"\n".join(texts))], pa.binary())],
                ["bucket", "data"])


def equal_groups(codes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Number of the group of equal windows for each window (first word in ``starts``); compared word by word."""
    draw = mixed(np.arange(1, int(codes.max(initial=0)) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = gram_hashes(draw[codes], k)[starts]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    left, right = starts[order][:-1][same], starts[order][1:][same]
    differ = np.zeros(len(left), bool)
    for i in range(k):
        differ |= codes[left + i] != codes[right + i]
    if differ.any():
        # Different windows under one hash: sort by the words themselves.
        rows = np.stack([codes[starts + i] for i in range(k)])
        order = np.lexsort(rows)
        same = (rows[:, order][:, 1:] == rows[:, order][:, :-1]).all(0)
    group = np.empty(len(starts), np.int64)
    group[order] = np.cumsum(np.r_[0, ~same])
    return group


def repeats(ids: np.ndarray, lows: np.ndarray, text: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(super-k-mer, first word, end) of the stretches of windows that start in a document with a smaller id.

    ``text`` has a line for each super-k-mer, its words apart by one space.
    """
    lines = pa.array(text.split(b"\n")).cast(pa.string())
    words = pc.split_pattern(lines, " ")
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = words.flatten().dictionary_encode().indices.to_numpy()
    del lines, words
    counts = sizes - k + 1
    holder = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(len(holder)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
    group = equal_groups(codes, starts, k)
    least = np.full(group.max(initial=-1) + 1, NO_ID)
    np.minimum.at(least, group, ids[holder])
    hit = np.flatnonzero(least[group] < ids[holder])
    if not len(hit):
        return hit, hit, hit
    cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(holder[hit]) != 0)) + 1
    first, last = hit[np.r_[0, cut]], hit[np.r_[cut - 1, len(hit) - 1]]
    own = holder[first]
    return own, lows[own] + offset[first], lows[own] + offset[last] + k


def span_batch(ids: np.ndarray, hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32())],
        ["doc_id", "h", "low", "high"])


def bucket_spans(parts: list[bytes], k: int) -> Iterator[pa.RecordBatch]:
    """Spans of one bucket.  A large one is taken a few sub-buckets at a time."""
    held: list[list[np.ndarray]] = [[], [], [], []]
    texts: list[bytes] = []
    for data in parts:
        arrays, text = unpacked(data, KINDS)
        for column, values in zip(held, arrays):
            column.append(values)
        if len(arrays[0]):
            texts.extend(text.split(b"\n"))
        if len(arrays[4]):
            yield span_batch(*arrays[4:])
    ids, hashes, lows, subs = (np.concatenate(column) for column in held)
    if not len(ids):
        return
    weight = np.bincount(subs, [len(t) for t in texts], SUB_BUCKETS)
    turn = (np.cumsum(weight) // SORT_BYTES)[subs]
    for t in np.unique(turn):
        at = np.flatnonzero(turn == t)
        own, low, high = repeats(ids[at], lows[at], b"\n".join(texts if len(at) == len(texts) else [texts[i] for i in at]), k)
        if len(own):
            yield span_batch(ids[at][own], hashes[at][own], low, high)


def bucket_batches(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come in order of bucket; a bucket is worked on when the next one begins."""
    bucket, parts = None, []
    for batch in batches:
        for number, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
            if number != bucket and parts:
                yield from bucket_spans(parts, k)
                parts = []
            bucket = number
            parts.append(data.as_py())
    if parts:
        yield from bucket_spans(parts, k)


def repeated_spans(docs: DataFrame, k: int = WINDOW_WORDS, m: int = MINIMISER_WORDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, h, low, high): word ranges of ``docs`` (doc_id, h, text) covered by windows that a smaller id has too.

    A null id is larger than any other.  Ranges of one document may overlap.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size * OVERLAP // bucket_bytes))
    partitions = max(1, min(buckets, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // 8)))
    sent = docs.select("doc_id", "h", "text").mapInArrow(lambda x: pack_batches(x, buckets, k, m), "bucket int, data binary")
    return sent.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda x: bucket_batches(x, k), SPANS)


REMOVED = "doc_id long, n_words long, n_removed long, kept string"


def squeezed_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=LEVEL)
    for part in text_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("h"), pa.array([press.compress(t.encode()) for t in texts_of(part, "text")], pa.binary())],
            ["doc_id", "h", "squeezed"])


def kept_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    open_up = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            for data, spans in zip(part.column("squeezed").to_pylist(), part.column("spans").to_pylist()):
                # Splits at the white space that words are told apart by.
                words = open_up.decompress(data).split()
                gone = np.zeros(len(words), bool)
                for span in spans or ():
                    gone[span["low"]:span["high"]] = True
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if spans else words
                rows.append((len(words), int(gone.sum()), b" ".join(kept).decode()))
            counts, removed, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])


def without_repeats(docs: DataFrame, k: int = WINDOW_WORDS, m: int = MINIMISER_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text); other columns are not read.

    ``kept`` is the text less every word that lies in a window of ``k`` words
    whose sequence also starts in a document with a smaller id, its words
    joined by one space.  Windows are judged on the input.  A null text and
    one of fewer than ``k`` words lose nothing.  A null id counts as larger
    than any other; rows that share an id never take words from each other;
    equal rows get equal results; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    keyed = texts.select("doc_id", F.xxhash64("text").alias("h"), "text")
    spans = staged(repeated_spans(keyed, k, m), "repeats").distinct().groupBy("doc_id", "h").agg(
        F.collect_list(F.struct("low", "high")).alias("spans"))
    squeezed = keyed.mapInArrow(squeezed_batches, "doc_id long, h long, squeezed binary")
    joined = squeezed.join(spans.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "spans"),
                           (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("d")) & (F.col("h") == F.col("g")), "left")
    return joined.select("doc_id", "squeezed", "spans").mapInArrow(kept_batches, REMOVED)
