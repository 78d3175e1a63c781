"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or.

Labels are known for documents, not for their sentences.  A sentence's logit is
a bias, less a multiple of the log of how many sentences its document has, plus
the weights of its words' parts (the word and its beginnings).  A document is
toxic if any of its sentences is: ``1 - prod(1 - p)``.  The weights are fitted
to the labels of documents through that product, so the model learns which
sentences are to blame, and :func:`score` reports where they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import WORDS, labelled_sample, split_words, text_or_empty, text_slices, without
from weftline.llm.quality import sigmoid

# Bound of the training sample: labelled documents of each label, and bytes of their whole texts.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 10_000_000
# A part of a word is a feature if so many toxic sampled documents have it, more of them than chance explains.
LEAST_DOCS, LEAST_GAIN, MOST_PARTS = 3, 4.0, 20_000
SHORTEST, LONGEST = 4, 8
ROUNDS, RATE, DECAY = 400, 0.05, 1e-4
MEMO_WORDS = 300_000
THRESHOLD = 0.3
# A sentence is to blame if it alone is toxic with this probability, or if none of its document is more so.
BLAME = 0.2

LETTERS = re.compile(r"[^\W\d_]+")
# Stands for a line feed among the words.
BREAK = "\x1e"
ENDS = (".", "!", "?", "…", "。", "！", "？", BREAK)

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                     T.StructField("score", T.DoubleType())])
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    crowd: float

    def logits(self, sums: np.ndarray, sentences: np.ndarray) -> np.ndarray:
        return self.bias - self.crowd * np.log(sentences) + sums


def parts(word: str) -> set[str]:
    """Every run of letters in a word, in lower case: its beginnings of 4 to 8 letters and the whole of it."""
    found = set()
    for run in LETTERS.findall(word.lower()):
        found.update(run[:n] for n in range(SHORTEST, min(LONGEST, len(run)) + 1))
        if not SHORTEST <= len(run) <= LONGEST:
            found.add(run)
    return found


@dataclass
class Sentences:
    """Words of a slice of texts and the sentences they stand in."""

    words: list[str]        # distinct words
    codes: np.ndarray       # of each word in turn, its place in ``words``
    sentence: np.ndarray    # of each word in turn, the sentence it is in
    doc: np.ndarray         # of each sentence, its text

    def per_doc(self, texts: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=texts)


def sentences_of(texts: pa.Array) -> Sentences:
    """A sentence ends with a word that ends in a full stop or the like, with a line, or with the text."""
    words, counts = split_words(pc.replace_substring(pc.fill_null(texts, ""), "\n", f" {BREAK} "))
    if not len(words):
        return Sentences([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    coded = words.dictionary_encode()
    distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    ending = np.array([w.endswith(ENDS) for w in distinct])[codes]
    doc = np.repeat(np.arange(len(counts)), counts)
    begins = np.r_[True, ending[:-1] | (doc[1:] != doc[:-1])]
    said = np.array([w != BREAK for w in distinct])[codes]
    # Numbers of sentences that have a word besides the break.
    numbers = np.cumsum(begins) - 1
    filled, sentence = np.unique(numbers[said], return_inverse=True)
    return Sentences(distinct, codes[said], sentence, doc[begins][filled])


def noisy_or(logits: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """Minus the log of the chance that no sentence is toxic, by text."""
    return np.bincount(doc, np.logaddexp(0, logits), texts)


def expanded(firsts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists laid end to end in ``flat``: the items of those at ``places``, and which of ``places`` each is from."""
    times = sizes[places]
    owner = np.repeat(np.arange(len(places)), times)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    return flat[firsts[places][owner] + inner], owner


def gains(toxic: np.ndarray, clean: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Gain in log likelihood from telling documents with a part from others; 0 where toxic ones do not have it more often."""
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)

    def part(k, n, p):
        return np.where(k > 0, k * np.log(np.maximum(k, 1) / n / p), 0.0)

    p = np.clip((toxic + clean) / (n1 + n0), 1e-12, 1 - 1e-12)
    gain = part(toxic, n1, p) + part(clean, n0, p) + part(n1 - toxic, n1, 1 - p) + part(n0 - clean, n0, 1 - p)
    return np.where((toxic >= LEAST_DOCS) & (toxic / n1 > clean / n0), gain, 0.0)


def fitted(texts: pa.Array, y: np.ndarray, share: float) -> Model:
    """Weights, bias and crowd that make the documents' labels likely.

    Adam on the log loss of the noisy-or, with weights of 0 or more; documents
    are weighted so that toxic ones have their ``share`` of all labelled rows.
    """
    found = sentences_of(texts)
    numbers: dict[str, int] = {}
    lists = [sorted(numbers.setdefault(part, len(numbers)) for part in parts(w)) for w in found.words]
    sizes = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter((i for x in lists for i in x), np.int64, sizes.sum())
    firsts = np.cumsum(sizes) - sizes
    # Which documents have a part at all.
    with_word = np.unique(found.doc[found.sentence].astype(np.int64) * (len(lists) + 1) + found.codes)
    column, pair = expanded(firsts, sizes, flat, with_word % (len(lists) + 1))
    having = np.unique((with_word // (len(lists) + 1))[pair] * (len(numbers) + 1) + column)
    label = y[having // (len(numbers) + 1)]
    per_part = [np.bincount(having % (len(numbers) + 1), label == value, len(numbers)) for value in (1, 0)]
    gain = gains(*per_part, y)
    chosen = np.argsort(-gain, kind="stable")[:MOST_PARTS]
    chosen = chosen[gain[chosen] >= LEAST_GAIN]
    renumbered = np.full(len(numbers) + 1, -1, np.int64)
    renumbered[chosen] = np.arange(len(chosen))
    names = list(numbers)
    known = [names[i] for i in chosen]
    # Sparse matrix of sentences by chosen parts, as (row, column) pairs; repeats count.
    kept = renumbered[flat] >= 0
    sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
    columns, place = expanded(np.cumsum(sizes) - sizes, sizes, renumbered[flat][kept], found.codes)
    rows = found.sentence[place]
    # Texts without a word are one empty sentence.
    bare = np.flatnonzero(found.per_doc(len(y)) == 0)
    doc = np.r_[found.doc, bare].astype(np.int64)
    crowd_of = np.log(np.bincount(doc, minlength=len(y)))[doc]
    toll = np.where(y == 1, share * len(y) / max(y.sum(), 1), (1 - share) * len(y) / max((1 - y).sum(), 1)) / len(y)

    params = np.r_[np.full(len(known), 0.5), np.log(max(share, 1e-3)) - 1, 1.0]
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, ROUNDS + 1):
        sums = np.bincount(rows, params[:-2][columns], len(doc))
        z = sums + params[-2] - params[-1] * crowd_of
        none = noisy_or(z, doc, len(y))
        # d loss / d none: 1 for clean documents, -(1 - P) / P for toxic ones.
        slope = toll * np.where(y == 1, -1 / np.expm1(np.clip(none, 1e-4, 500)), 1.0)
        back = slope[doc] * sigmoid(z)
        grad = np.r_[np.bincount(columns, back[rows], len(known)), back.sum(), -(back * crowd_of).sum()]
        grad[:-2] += DECAY * params[:-2]
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        params -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        params[:-2] = np.maximum(params[:-2], 0.0)
        params[-1] = max(params[-1], 0.0)
    weights = {part: float(w) for part, w in zip(known, params) if w > 1e-3}
    return Model(weights, float(params[-2]), float(params[-1]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """Model from rows of ``labels`` (doc_id, toxic) and the whole texts of their documents; None without any.

    The sample has up to ``sample`` documents of each label, in the order of a
    hash of their ids, as long as their texts together have at most
    ``sample_bytes``; a single text of over a sixteenth of that is left out of
    it.  The share of toxic documents is counted over all labels.  A document
    labelled twice counts as toxic if one label says so; a null label or id
    teaches nothing.
    """
    h = F.xxhash64("doc_id", F.lit(5))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.max("toxic") >= 1).alias("y"))
    shares = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    if shares is None:
        return None
    drawn = None
    for label in (True, False):
        some = known.where(F.col("y") == label).orderBy(h, "doc_id").limit(sample)
        drawn = some if drawn is None else drawn.unionByName(some)
    # At most 2 x `sample` rows of an id and a label.
    taken = sorted(labelled_sample(docs, drawn, 5, sample_bytes), key=lambda r: str(r["doc_id"]))
    if not taken:
        return None
    return fitted(pa.array([r["text"] for r in taken], pa.string()), np.array([float(r["y"]) for r in taken]), shares)


def spans_of(text: str) -> list[tuple[int, int, list[str]]]:
    """Start and end of each sentence in code points, and its words, as :func:`sentences_of` divides them."""
    found, words, start, end = [], [], 0, 0
    for match in WORDS.finditer(text):
        if words and "\n" in text[end:match.start()]:
            found.append((start, end, words))
            words = []
        word = match.group()
        if word != BREAK:
            start = start if words else match.start()
            words.append(word)
            end = match.end()
        if words and word.endswith(ENDS):
            found.append((start, end, words))
            words = []
    if words:
        found.append((start, end, words))
    return found


class Scorer:
    """Scores texts with a model; keeps the weights of words it has met, within a bound."""

    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def weight(self, word: str) -> float:
        known = self.model.weights
        return sum(known.get(part, 0.0) for part in parts(word))

    def weights(self, words: list[str]) -> np.ndarray:
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        memo = self.memo
        for word in words:
            if word not in memo:
                memo[word] = self.weight(word)
        return np.fromiter((memo[w] for w in words), float, len(words))

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Chance of each text that a sentence of it is toxic; a text without words is one empty sentence."""
        found = sentences_of(texts)
        sums = np.bincount(found.sentence, self.weights(found.words)[found.codes], len(found.doc)) if found.words else np.zeros(0)
        per_doc = found.per_doc(len(texts))
        bare = np.flatnonzero(per_doc == 0)
        doc, sums = np.r_[found.doc, bare].astype(np.int64), np.r_[sums, np.zeros(len(bare))]
        z = self.model.logits(sums, np.maximum(per_doc, 1)[doc])
        return -np.expm1(-noisy_or(z, doc, len(texts)))

    def blamed(self, text: str) -> list[dict]:
        """The sentences of a toxic text that are to blame."""
        found = spans_of(text)
        if not found:
            return []
        sums = np.array([sum(map(self.weight, words)) for _, _, words in found])
        p = sigmoid(self.model.logits(sums, len(found)))
        return [{"start": a, "end": b, "score": float(x)} for (a, b, _), x in zip(found, p) if x >= min(BLAME, p.max())]


def score_batches(batches: Iterable[pa.RecordBatch], model: Model | None, threshold: float) -> Iterator[pa.RecordBatch]:
    scorer = model and Scorer(model)
    for part in text_slices(batches, "__text"):
        texts = part.column(part.num_columns - 1)
        scores = scorer.scores(texts) if scorer else np.zeros(part.num_rows)
        toxic = scores >= threshold
        blamed = [scorer.blamed(text.as_py()) if hit and scorer else [] for text, hit in zip(texts, toxic)]
        columns = [pa.array(scores, pa.float64()), pa.array(toxic.astype(np.int32)), pa.array(blamed, SPANS)]
        yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], [*part.schema.names[:-1], "score", "predicted", "offending"])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score``, ``predicted`` (1 from ``threshold`` on) and ``offending`` to every row.

    ``offending`` has the place (code points, end exclusive) and chance of each
    sentence of a toxic text that is to blame.  Only the text counts.  Null and
    empty texts are one sentence without words; without a model every score is
    0.  Repeated rows get the same score and an empty table gives an empty one.
    Other columns stay; input columns called like a result give way.
    """
    kept = without(docs, "score", "predicted", "offending", "__text").withColumn("__text", text_or_empty())
    schema = T.StructType([*kept.schema.fields[:-1], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("offending", T.ArrayType(SPAN))])
    return kept.mapInArrow(lambda batches: score_batches(batches, model, threshold), schema)
