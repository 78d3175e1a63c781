"""Small documents with every odd case, and brute-force versions of the operators."""

import hashlib
import random
import re

from pyspark.sql import types as T

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns called like results and helpers of the operators.
    *[T.StructField(name, T.StringType()) for name in ("score", "IDS", "h", "row", "spans", "size", "key", "component", "src", "__id")],
])
CLASH = tuple("x" for _ in DOCS.fields[5:])


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *CLASH)


def vocabulary(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents with copies, near copies, shared passages, short, empty, null and long texts, and equal rows."""
    rng, words = random.Random(seed), vocabulary(seed)
    passage = prose(rng, words, 30)
    base = prose(rng, words, 120)
    rows = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = base if i < 30 else base.upper()
        elif kind == 1:
            own = base.split(" ")
            own[rng.randrange(120)] = rng.choice(words)
            text = " ".join(own)
        elif kind == 2:
            text = prose(rng, words, 20) + "\n\t" + passage + " \x0b" + prose(rng, words, rng.randint(0, 20))
        elif kind == 3:
            text = prose(rng, words, rng.randint(1, 4))
        else:
            text = prose(rng, words, rng.randint(5, 200))
        rows.append(row(i, text, source=rng.choice(["a", "b", "ä", None])))
    rows += [
        row(1001, None, None, None), row(1002, ""), row(1003, " \n\t "), row(1004, "one"), row(1005, "one two"), row(1006, "é😀 ▁x▁ \x00\x85 \xa0y"),
        row(1007, prose(rng, words, 20_000)), row(1008, "same text twice here"), row(1008, "same text twice here"), row(1009, "same text twice here"),
        row(None, "no id but " + passage), row(1010, "loop " * 50), row(1011, "a" * 5000),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
