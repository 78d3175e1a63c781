"""Spelling variants by pivotal bigrams.

Bigrams are ordered from rare to frequent.  A word's prefix has its three first
bigrams in that order (all places of each), and two of them that share no
letter, chosen for the least total frequency, are its pivots.  One edit spoils
at most one of two such bigrams.  So of two words that are one edit apart, the
one whose prefix ends earlier in the order has a pivot that stands in the
other's prefix, at most one place away; and as the edit is all on one side of
it, the words agree from their start through the pivot or from the pivot to
their end.  Words meet on that agreement and their lengths, and are verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import text_or_empty
from weftline.session import staged

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
GRAM, PREFIX = 2, 3
TIMES = 2
# Letters of RUN after lower-casing; the order of bigrams has their square at most.
LETTERS = 26 + 0x100 - 0xC0


def slipped(doc_id: Column, run: Column) -> Column:
    """The lower-cased run, less a letter where its hash with the document's id says so; a null id counts as empty."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts with at least so many letters and occurrences; a null text has none."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.translate(text_or_empty(), UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    # A letter may go, so shorter runs never count.
    words = runs.where(F.length("run") >= length).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Place in the order from rare to frequent, and frequency, of each bigram; at most the square of LETTERS."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))).alias("gram"))
    counts = grams.groupBy("gram").count().collect()
    return {g: (i, k) for i, (k, g) in enumerate(sorted((r["count"], r["gram"]) for r in counts))}


def pivots(places: list[int], costs: list[int]) -> tuple[int, int]:
    """The two places at least a bigram apart with the least total cost; ``places`` ascend.

    One pass: ``best`` is the cheapest first pivot that ends before the current place.
    """
    best, chosen, free = None, None, 0
    for place, cost in zip(places, costs):
        while places[free] <= place - GRAM:
            if best is None or costs[free] < best[0]:
                best = costs[free], places[free]
            free += 1
        if best is not None and (chosen is None or best[0] + cost < chosen[0]):
            chosen = best[0] + cost, best[1], place
    return chosen[1:]


def keys_of(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[int], tuple[int, int]]:
    """The order's place at which the prefix ends, the prefix's places in the word, and the pivots."""
    ranks = [order[word[i:i + GRAM]] for i in range(len(word) - GRAM + 1)]
    end = sorted(r for r, _ in ranks)[PREFIX - 1]
    places = [i for i, (r, _) in enumerate(ranks) if r <= end]
    return end, places, pivots(places, [ranks[i][1] for i in places])


KEYS = "word string, n long, end int, key string, size int"


def key_batches(batches: Iterable[pa.RecordBatch], order: dict, probe: bool) -> Iterator[pa.RecordBatch]:
    """Rows of KEYS: a word's beginnings through, and ends from, its pivots (``probe``) or all its prefix's bigrams.

    ``size`` is the length of the other word; a probe asks for one less, as many and one more.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, 5000):
            rows = []
            for word, n in zip(*(c.to_pylist() for c in batch.slice(start, 5000).columns)):
                end, places, chosen = keys_of(word, order)
                for place in chosen if probe else places:
                    for key in ("<" + word[:place + GRAM], ">" + word[place:]):
                        rows.extend((word, n, end, key, len(word) + d) for d in ((-1, 0, 1) if probe else (0,)))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int32()))], ["word", "n", "end", "key", "size"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) for every two of ``words`` (word, n) one edit apart, each way round."""
    order = gram_order(words)
    probes = words.mapInArrow(lambda batches: key_batches(batches, order, True), KEYS)
    index = words.mapInArrow(lambda batches: key_batches(batches, order, False), KEYS)
    met = probes.alias("p").join(index.alias("i"), ["key", "size"]).where(
        (F.col("p.end") <= F.col("i.end")) & (F.col("p.word") != F.col("i.word")) & (F.levenshtein("p.word", "i.word", 1) == 1))
    a, b = F.struct(F.col("p.word").alias("w"), F.col("p.n").alias("n")), F.struct(F.col("i.word").alias("w"), F.col("i.n").alias("n"))
    pairs = met.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return pairs.select(both.alias("p")).select(
        F.col("p.a.w").alias("a"), F.col("p.a.n").alias("a_n"), F.col("p.b.w").alias("b"), F.col("p.b.n").alias("b_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): where following forms ends.

    Every round doubles the steps taken, and a form occurs at least twice as
    often as its word, so rounds grow with the log of the log of the counts.
    """
    steps = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return steps


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Form and root of every word of ``words`` (word, n), distinct words of at least four letters.

    Columns: word, form, root, n, n_near, form_n.  Two words are near if they
    differ by one inserted, deleted or replaced code point.  A word's form is
    its most frequent near word (ties: the first in code-point order) if that
    is at least ``times`` as frequent as the word; its root is where forms end,
    itself without a form.  No words give no rows.
    """
    words = staged(words, "spelling-words")
    best = near_pairs(words).groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("w"))).alias("best"))
    near = staged(best.select(F.col("a").alias("word"), "n_near", F.col("best.w").alias("form"), (-F.col("best.m")).alias("form_n")), "spelling-near")
    joined = words.join(near, "word", "left")
    is_form = F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False))
    found = staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                 F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "spelling-forms")
    return found.join(roots(found.where(F.col("form").isNotNull()).select("word", "form")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
