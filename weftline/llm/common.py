"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import staged

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

# Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 4 << 20


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns called like a result column, in any letter case."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def with_text(text: Column, schema: T.StructType) -> Column:
    """The row in column ``doc`` (a struct of ``schema``) with another text, and ``n_chars`` to match where it has one."""
    doc = F.col("doc").withField("text", text)
    if "n_chars" in schema.fieldNames():
        doc = doc.withField("n_chars", F.length(text).cast(schema["n_chars"].dataType))
    return doc


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold(doc_id: Column, folds: int = 4) -> Column:
    """Fold of a document by the CRC-32 of its id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def labelled_sample(docs: DataFrame, drawn: DataFrame, seed: int, most_bytes: int) -> list:
    """Rows (doc_id, y, text) of the documents in ``drawn`` (doc_id, y; few rows), whole texts within a bound.

    Texts are taken in the order of a hash of their ids as long as they have
    ``most_bytes`` together; a single one of over a sixteenth of that is not in
    the sample.  Of several texts of one id the least counts.
    """
    h = F.xxhash64("doc_id", F.lit(seed))
    rows = staged(docs.where(F.octet_length("text") <= most_bytes // 16).select("doc_id", "text").join(
        F.broadcast(drawn), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")), "labelled-sample")
    sizes = rows.select("doc_id", F.octet_length("text").alias("size")).orderBy(h, "doc_id").collect()
    total = np.cumsum([r["size"] for r in sizes])
    within = [(r["doc_id"],) for r, t in zip(sizes, total) if t <= most_bytes]
    if not within:
        return []
    ids = docs.sparkSession.createDataFrame(within, T.StructType([rows.schema["doc_id"]]))
    return rows.join(F.broadcast(ids), "doc_id").collect()


def text_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts of a slice, empty for null."""
    return [value or "" for value in batch.column(column).to_pylist()]


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and the number in each; null has none.  ``lower`` is for A-Z only."""
    trimmed = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.ascii_split_whitespace(pc.ascii_lower(trimmed) if lower else trimmed)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    counts[pc.binary_length(trimmed).to_numpy(zero_copy_only=False) == 0] = 0
    words = lists.flatten()
    return words.filter(pc.greater(pc.binary_length(words), 0)), counts


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = words.dictionary_encode()
    return pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object), categorize=False)[coded.indices.to_numpy()]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all places."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:len(hashes) - n + 1 + i]
    return mixed(total)
