"""SentencePiece encoding and decoding through a table of distinct marked words.

No piece of a suitable model has the white-space marker after another
character, so no merge crosses the start of a marked word.  Each distinct
marked word is segmented once for a run of documents and the ids are joined
back by position.  The table lives inside the task and is bounded by its bytes,
so nothing is shuffled; a task segments the common words of its own texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import text_or_empty, text_slices, without

MARKER = "▁"
CHUNK = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
# Bytes of distinct words and ids that a task keeps before its table is started afresh, and of text in a slice.
TABLE_BYTES, PIECE_BYTES = 48 << 20, 1 << 20
# Words looked up at a time, and what Python needs for an entry besides its bytes.
WORDS_AT_ONCE, ENTRY_BYTES = 100_000, 150


def splits_at_markers(processor) -> bool:
    """Whether marked words can be segmented one by one with the same ids.

    That takes a model whose pieces have markers only in front, that adds a
    marker at the start, keeps runs of spaces and leaves other text as it is.
    """
    crossing = re.compile(f"[^{MARKER}]{MARKER}")
    probe = "a  ﬁ é "
    return (
        not any(crossing.search(processor.id_to_piece(i)) for i in range(processor.get_piece_size()))
        and processor.normalize(probe) == MARKER + probe.replace(" ", MARKER)
    )


class Encoder:
    """Encodes texts word by word through a table of distinct marked words, within a bound of bytes."""

    def __init__(self, model: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.by_word = splits_at_markers(self.processor)
        self.marker = array("i", [self.processor.piece_to_id(MARKER)]).tobytes()
        self.table: dict[str, bytes] = {}
        self.size = 0

    def words(self, words: list[str]) -> bytes:
        """Ids of marked words in a row; each distinct word that is not in the table is segmented once."""
        missing = list(set(words).difference(self.table))
        if missing:
            if self.size > TABLE_BYTES:
                self.table, self.size = {}, 0
                missing = list(set(words))
            # The library puts the marker in front again; a lone marker is a piece of its own.
            for word, ids in zip(missing, self.processor.encode([word[1:] for word in missing], num_threads=1)):
                coded = self.marker if word == MARKER else array("i", ids).tobytes()
                self.table[word] = coded
                self.size += len(word.encode()) + len(coded) + ENTRY_BYTES
        return b"".join(map(self.table.__getitem__, words))

    def ids(self, text: str) -> np.ndarray:
        if not self.by_word:
            return np.array(self.processor.encode(text), np.int32)
        if not text:
            return np.zeros(0, np.int32)
        found = (match.group() for match in CHUNK.finditer(MARKER + text.replace(" ", MARKER)))
        return np.frombuffer(b"".join(map(self.words, iter(lambda: list(islice(found, WORDS_AT_ONCE)), []))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.processor.decode(ids.tolist())


def encode_batches(batches: Iterable[pa.RecordBatch], model: str, check: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(model)
    for part in text_slices(batches, "__text", PIECE_BYTES):
        lists, results = [], []
        for text in part.column("__text"):
            text = text.as_py() or ""
            lists.append(encoder.ids(text))
            decoded = encoder.decode(lists[-1])
            results.append(decoded == text if check else decoded)
        offsets = np.zeros(len(lists) + 1, np.int32)
        np.cumsum([len(ids) for ids in lists], out=offsets[1:])
        columns = [pa.ListArray.from_arrays(offsets, np.concatenate(lists)), pa.array(results, pa.bool_() if check else pa.string())]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], "ids", "restored" if check else "decoded"])
        # Workers serve one stage after another; what a slice needed goes back.
        del lists, results, columns
        pa.default_memory_pool().release_unused()


def encoded(docs: DataFrame, model: str, text: str, check: bool) -> DataFrame:
    kept = without(docs, "ids", "restored" if check else "decoded", "__text").withColumn("__text", text_or_empty(text))
    result = T.StructField("restored", T.BooleanType()) if check else T.StructField("decoded", T.StringType())
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), result])
    return kept.mapInArrow(lambda batches: encode_batches(batches, model, check), schema)


def encode_decode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int) and ``decoded`` (string) to every row.

    ``model`` is a model file that every executor can read.  No begin or end
    ids, no sampling.  A null text counts as empty and gives no ids and an
    empty text; repeated rows are encoded each; an empty table gives an empty
    table.  Other columns stay; input columns called like a result give way.
    """
    return encoded(docs, model, text, False)


def encode_checked(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """As :func:`encode_decode`, but with ``restored`` (whether decoding gives back the text) for the decoded text."""
    return encoded(docs, model, text, True)


def token_digests(encoded: DataFrame) -> DataFrame:
    """Per row of :func:`encode_decode`: number of ids and digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
