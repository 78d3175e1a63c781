"""Language identification by compression.

A language is a zstandard dictionary of raw content: whole sampled texts of it,
one after the other, with nothing but letters and marks left.  Sentences in a
sampled text that another language's other texts compress better are quotations
and stay out.  A text belongs to the language whose dictionary compresses it to
the fewest bytes; a narrow margin is reported as a rejection.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import text_or_empty, text_slices, texts_of, without

UNKNOWN = "und"
# Bound of the training sample: texts that are drawn for each language, and bytes of those that are taken.
SAMPLE_TEXTS, DICTIONARY_BYTES = 256, 64_000
# A whole text is compressed in chunks, so that the dictionary helps all along it.
CHUNK_BYTES = 8192
LEVEL = 6
# Combining marks belong to their letters.
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
# Smallest gain over the second language, as a share of the best size.
MARGIN = 0.01
SENTENCE_END = regex.compile(r"[.!?。！？\n]+")


def letters_of(text: str) -> str:
    """Letters with their marks in lower case; digits and signs say nothing of the language."""
    return NOT_LETTERS.sub(" ", text.lower())


def learn_dictionaries(docs: DataFrame, texts: int = SAMPLE_TEXTS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Raw dictionary by language from rows of (text, lang); null languages and texts teach nothing.

    For every language the texts are dealt to ``texts`` groups by a hash and the
    least hash of each is drawn, so equal texts are one.  Whole texts are taken
    in the order of their hash as long as they are ``size`` bytes together; a
    single one of over a quarter of that is not in the sample.  So the driver
    gets at most ``size`` bytes of text a language, however many rows there are
    or are repeated.
    """
    h = F.xxhash64("text", F.lit(1))
    known = docs.where(F.col("lang").isNotNull() & (F.octet_length("text") <= size // 4)).select(
        F.col("lang").cast("string").alias("lang"), "text", h.alias("h"))
    drawn = known.groupBy("lang", F.pmod("h", F.lit(texts)).alias("g")).agg(
        F.min(F.struct("h", F.octet_length("text").alias("n"))).alias("least")).select("lang", "least.*").collect()
    taken, room = [], {}
    for row in sorted(drawn, key=lambda r: (r["lang"], r["h"])):
        left = room.get(row["lang"], size)
        if row["n"] <= left:
            taken.append((row["lang"], row["h"]))
            room[row["lang"]] = left - row["n"]
    if not taken:
        return {}
    # At most `texts` rows of two values for each language.
    wanted = docs.sparkSession.createDataFrame(taken, "lang string, h long")
    rows = known.join(F.broadcast(wanted), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).collect()
    content: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        content.setdefault(row["lang"], []).append(row["text"])
    return raw_dictionaries(content)


def raw_dictionaries(content: dict[str, list[str]]) -> dict[str, bytes]:
    """Dictionary by language: its texts without the sentences that are another language's.

    A passage that is copied into texts of several languages would draw others
    that have it to wherever it was sampled.  So the sentences of each half of
    the texts are judged by the dictionaries of the other half.
    """
    halves = [{lang: letters_of(" ".join(parts[k::2])).encode() for lang, parts in content.items()} for k in (0, 1)]
    langs = sorted(content)
    judges = [compressors(half) for half in halves]
    kept: dict[str, bytes] = {}
    for lang, parts in content.items():
        sentences = []
        for i, text in enumerate(parts):
            for sentence in SENTENCE_END.split(text):
                data = letters_of(sentence).strip()
                if not data:
                    continue
                sizes = compressed_sizes(data, judges[1 - i % 2])
                if sizes[langs.index(lang)] <= sizes.min() * (1 + MARGIN):
                    sentences.append(data)
        kept[lang] = " ".join(sentences).encode() or letters_of(" ".join(parts)).encode()
    return kept


def compressors(dictionaries: dict[str, bytes]) -> list:
    import zstandard

    made = []
    for lang in sorted(dictionaries):
        # The library takes no dictionary below eight bytes.
        content = zstandard.ZstdCompressionDict(dictionaries[lang].ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(
            level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
    return made


def compressed_sizes(letters: str, compress: list) -> np.ndarray:
    """Bytes of a text of :func:`letters_of` with each dictionary."""
    data = letters.encode()
    sizes = np.zeros(len(compress))
    for start in range(0, len(data), CHUNK_BYTES):
        chunk = data[start:start + CHUNK_BYTES]
        sizes += [len(f(chunk)) for f in compress]
    return sizes


def judged(text: str, langs: list[str], dictionaries: list[bytes], compress: list, margin: float) -> tuple[str, float, bool]:
    """Language, score and whether the margin is narrow.

    A text of a few words is often stored as it is by all; then the dictionary
    that has most of its words counts as smallest.
    """
    if not langs or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    letters = letters_of(text)
    sizes = compressed_sizes(letters, compress)
    ties = np.flatnonzero(sizes == sizes.min())
    best = int(ties[0])
    if len(ties) > 1:
        words = [w.encode() for w in letters.split()]
        best = int(max(ties, key=lambda i: (sum(len(w) for w in words if b" " + w + b" " in dictionaries[i]), -i)))
    rest = np.delete(sizes, best)
    narrow = len(rest) > 0 and rest.min() - sizes[best] < margin * sizes[best]
    return langs[best], float(1 / np.exp2(np.maximum(sizes[best] - sizes, -1000)).sum()), bool(narrow)


def identify_batches(batches: Iterable[pa.RecordBatch], dictionaries: dict[str, bytes], margin: float) -> Iterator[pa.RecordBatch]:
    langs, compress = sorted(dictionaries), compressors(dictionaries)
    contents = [dictionaries[lang] for lang in langs]
    for part in text_slices(batches, "__text"):
        found = [judged(text, langs, contents, compress, margin) for text in texts_of(part, "__text")]
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], "lang_pred", "score", "narrow"])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``narrow`` to every row, from its text alone.

    ``narrow`` marks a text whose best language is hardly better than the next;
    callers that want to reject such texts drop them.  A null text, one without
    a letter, or having learned no language gives ``und``, 0 and narrow.  Equal
    sizes go to the language that knows most of the words, then by name.  Rows are judged one by one, so
    repeated rows get the same answer and an empty table an empty one.  Other
    columns stay; input columns called like a result give way.
    """
    kept = without(docs, "lang_pred", "score", "narrow", "__text").withColumn("__text", text_or_empty())
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("narrow", T.BooleanType())])
    return kept.mapInArrow(lambda batches: identify_batches(batches, dictionaries, margin), schema)
