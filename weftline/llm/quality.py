"""Quality classifier: random-indexing word vectors, pooled, and a small network.

Words are looked at by their form (letter case, digits, signs), and frequent
words also by themselves.  Forms and frequent words have a sparse random index
vector each; a word vector adds to it the index vectors of its neighbours in the
training sample, where a rare neighbour counts by its form.  A
document is the mean of its words' vectors, over its whole text.  Two dense
layers give a logit, which a temperature fitted on documents that the network
has not seen turns into a calibrated probability.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import WORDS, labelled_sample, text_or_empty, text_slices, texts_of, without

# Bound of the training sample: labelled documents, and bytes of their whole texts.
SAMPLE_DOCS, SAMPLE_BYTES = 3000, 6_000_000
DIMENSIONS, NONZEROS, HIDDEN = 64, 6, 24
# A word counts as frequent in this many sampled documents; at most so many words are kept.
FREQUENT_DOCS, FREQUENT_WORDS = 40, 2000
# Vectors for forms that the sample does not have, dealt by hash.
SPARE = 256
WINDOW = 2
REPEAT = "="
MEMO_WORDS = 300_000
THRESHOLD = 0.7

LETTERS = re.compile(r"[^\W\d_]+")
DIGITS = re.compile(r"\d+")
SIGNS = re.compile(r"([^aA0])\1+")


def case_of(match: re.Match) -> str:
    run = match.group()
    if run.isupper() and len(run) > 1:
        return "AA"
    return "Aa" if run[0].isupper() else "a"


def form(word: str) -> str:
    """``Hello,`` is ``Aa,`` and ``IN!!`` is ``AA!!``; runs of a sign count as two."""
    if word.isalpha() and word.islower():
        return "a"
    return SIGNS.sub(r"\1\1", DIGITS.sub("0", LETTERS.sub(case_of, word)))


def index_vector(name: str) -> np.ndarray:
    """Sparse vector of signs drawn from the name's hash."""
    rng = np.random.default_rng(zlib.crc32(name.encode()))
    vector = np.zeros(DIMENSIONS, np.float32)
    vector[rng.choice(DIMENSIONS, NONZEROS, replace=False)] = rng.choice([-1.0, 1.0], NONZEROS)
    return vector


@dataclass
class Model:
    forms: dict[str, int]
    frequent: dict[str, int]
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float


def in_context(samples: list[list[str]], names: set[str]) -> np.ndarray:
    """Vectors of ``names`` in their order: index vector, plus the mean index vector of the neighbours in the samples."""
    order = sorted(names)
    place = {name: i for i, name in enumerate(order)}
    own = np.stack([index_vector(name) for name in order]) if order else np.zeros((0, DIMENSIONS), np.float32)
    total, times = np.zeros_like(own), np.zeros(len(order))
    # Sums add up over a few documents at a time, so that no list of all pairs is held.
    for start in range(0, len(samples), 50):
        pairs = [np.zeros(0, np.int64)]
        for words in samples[start:start + 50]:
            at = np.fromiter((place[w] for w in words), np.int64, len(words))
            for step in range(1, WINDOW + 1):
                pairs += [at[:-step] * len(order) + at[step:], at[step:] * len(order) + at[:-step]]
        found, n = np.unique(np.concatenate(pairs), return_counts=True)
        if len(found):
            np.add.at(times, found // len(order), n)
            np.add.at(total, found // len(order), own[found % len(order)] * n[:, None].astype(np.float32))
    return own + total / np.maximum(times, 1)[:, None]


def word_vectors(samples: list[list[str]]) -> tuple[dict[str, int], dict[str, int], np.ndarray]:
    """Tables of forms and frequent words, and their vectors with the spare ones last."""
    in_docs = Counter()
    for words in samples:
        in_docs.update({word.lower() for word in words})
    frequent = [w for w, n in sorted(in_docs.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT_WORDS] if n >= FREQUENT_DOCS]
    # One string for all equal ones: the sample has many words, but few different ones.
    forms_of = {word: form(word) for word in set(chain.from_iterable(samples))}
    one: dict[str, str] = {}
    forms_of = {word: one.setdefault(f, f) for word, f in forms_of.items()}
    shapes = [[forms_of[word] for word in words] for words in samples]
    forms = {REPEAT, *chain.from_iterable(shapes)}
    known = set(frequent)
    # Names of words are marked, so that none is taken for a form.
    names_of = {word: one.setdefault("word " + word.lower(), "word " + word.lower()) if word.lower() in known else f for word, f in forms_of.items()}
    mixed = [[names_of[word] for word in words] for words in samples]
    names = {"word " + w for w in frequent} | forms
    words_at = {name: i for i, name in enumerate(sorted(names))}
    by_word = in_context(mixed, names)
    spare = np.stack([index_vector(f"spare {i}") for i in range(SPARE)])
    rows = [in_context(shapes, forms), *([np.stack([by_word[words_at["word " + w]] for w in frequent])] if frequent else []), spare]
    return ({name: i for i, name in enumerate(sorted(forms))}, {word: len(forms) + i for i, word in enumerate(frequent)},
            np.concatenate(rows).astype(np.float32))


class Pooler:
    """Pools the words of a text to its vector; keeps the ids of words it has met, within a bound."""

    def __init__(self, forms: dict[str, int], frequent: dict[str, int], vectors: np.ndarray):
        self.forms, self.frequent, self.vectors, self.memo = forms, frequent, vectors, {}
        self.spare = len(vectors) - SPARE

    def ids(self, word: str) -> tuple[int, int]:
        shape = form(word)
        return self.forms.get(shape, self.spare + zlib.crc32(shape.encode()) % SPARE), self.frequent.get(word.lower(), -1)

    def pool(self, words: list[str]) -> np.ndarray:
        """Mean vector by form, mean vector of the frequent words, share of immediate repeats."""
        out = np.zeros(2 * DIMENSIONS + 1, np.float32)
        if not words:
            return out
        counts = Counter(words)
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        for word in counts:
            if word not in self.memo:
                self.memo[word] = self.ids(word)
        ids = np.array(list(chain.from_iterable(map(self.memo.__getitem__, counts)))).reshape(-1, 2)
        times = np.fromiter(counts.values(), np.float32, len(counts))
        by_form = np.bincount(ids[:, 0], times, len(self.vectors)).astype(np.float32)
        repeats = sum(map(eq, words, words[1:]))
        by_form[self.forms[REPEAT]] += repeats
        out[:DIMENSIONS] = by_form @ self.vectors
        frequent = ids[:, 1] >= 0
        out[DIMENSIONS:-1] = times[frequent] @ self.vectors[ids[frequent, 1]]
        out /= len(words)
        out[-1] = repeats / len(words)
        return out


def network(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def trained(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.01, decay: float = 1e-3) -> tuple:
    """Two dense layers, fitted to the whole sample with Adam."""
    rng = np.random.default_rng(0)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, rounds + 1):
        hidden, z = network(x, tuple(layers))
        error = (sigmoid(z) - y) / len(y)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        slopes = [x.T @ back + decay * layers[0], back.sum(0), hidden.T @ error + decay * layers[2], error.sum(keepdims=True)]
        for p, m, v, g in zip(layers, first, second, slopes):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def temperature_of(z: np.ndarray, y: np.ndarray) -> float:
    """Temperature with the least log loss on documents the network was not fitted to."""
    def loss(t: float) -> float:
        p = np.clip(sigmoid(z / t), 1e-6, 1 - 1e-6)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    return min(np.geomspace(0.5, 8, 33), key=loss) if len(z) else 1.0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Model from rows of ``labels`` (doc_id, quality) and their whole texts; None without a labelled text.

    The sample is the ``sample`` labelled ids with the least hash, as long as
    their texts have ``sample_bytes`` together; a single text of over a
    sixteenth of that is not in it.  A fifth of it is set aside for the
    temperature.  A document labelled twice counts with its lower label.
    """
    drawn = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("y")).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample)
    rows = labelled_sample(docs, drawn, 3, sample_bytes)
    if not rows:
        return None
    rows.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    same: dict[str, str] = {}
    samples = [[same.setdefault(word, word) for word in WORDS.findall(r["text"])] for r in rows]
    y = np.array([1.0 if r["y"] >= 1 else 0.0 for r in rows])
    forms, frequent, vectors = word_vectors(samples)
    pooler = Pooler(forms, frequent, vectors)
    x = np.stack([pooler.pool(words) for words in samples]).astype(np.float64)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    x = (x - mean) / scale
    aside = np.arange(len(y)) % 5 == 4
    layers = trained(x[~aside], y[~aside])
    temperature = temperature_of(network(x[aside], layers)[1], y[aside])
    return Model(forms, frequent, vectors, mean, scale, layers, float(temperature))


def score_batches(batches: Iterable[pa.RecordBatch], model: Model | None, threshold: float) -> Iterator[pa.RecordBatch]:
    pooler = model and Pooler(model.forms, model.frequent, model.vectors)
    for part in text_slices(batches, "__text"):
        if model is None:
            scores = np.full(part.num_rows, 0.5)
        else:
            x = np.stack([pooler.pool(WORDS.findall(text)) for text in texts_of(part, "__text")])
            z = network(np.clip((x - model.mean) / model.scale, -20, 20), model.layers)[1]
            scores = sigmoid(z / model.temperature)
        columns = [pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], "score", "predicted"])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (probability of good quality) and ``predicted`` (1 from ``threshold`` on) to every row.

    Only the text counts.  Null and empty texts are pooled to zeros and scored
    like any other; without a model every score is 0.5.  Repeated rows get the
    same score and an empty table gives an empty one.  Other columns stay;
    input columns called like a result give way.
    """
    kept = without(docs, "score", "predicted", "__text").withColumn("__text", text_or_empty())
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return kept.mapInArrow(lambda batches: score_batches(batches, model, threshold), schema)
