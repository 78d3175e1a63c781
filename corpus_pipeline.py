"""From raw documents to token ids: a pipeline of five corpus operators.

Every stage is called with the session, the documents its predecessor kept and
the folder of the tables, and returns a frame that is written and read again
before the next one.  All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import minhash, mixing, pieces, quality, secrets
from weftline.llm.common import text_or_empty
from weftline.llm.queries import TOKENIZER, is_held_out, table
from weftline.session import bound_batches, staged, tune


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; rows keep all their columns.

    The classifier learns from the labelled documents of this input, less the
    held-out fold.  Without any label nothing is known of quality, and all stay.
    """
    bound_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~is_held_out(labels)))
    if model is None:
        return docs
    # A clash of names is avoided by carrying the row as one column.
    scored = quality.score(docs.select(F.struct("*").alias("doc"), "text"), model)
    return scored.where(F.col("predicted") == 1).select("doc.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near copies (five words, 0.8).

    Equal rows are one document.  Documents without an id stay where no equal
    has one.
    """
    bound_batches(spark)
    groups = minhash.near_duplicates(docs.select("doc_id", "text"))
    chosen = groups.where(F.col("kept") | F.col("component_id").isNull()).select(F.col("doc_id").alias("kept_id")).distinct()
    # The row travels as one column, so none of its names can clash.
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("i"), F.xxhash64(text_or_empty()).alias("h"))
    kept = keyed.join(chosen, keyed["i"].eqNullSafe(chosen["kept_id"]), "left_semi")
    return kept.dropDuplicates(["i", "h"]).select("doc.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts; widely copied examples are marked apart from live ones."""
    return secrets.redacted(docs, secrets.scan(docs))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: for each pass over a document a row with the words taken from it."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with whether decoding gives back the text."""
    bound_batches(spark)
    # The texts do not leave the worker again.
    coded = pieces.encode_checked(docs.select("doc_id", "lang", "source", "text"), TOKENIZER)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "restored")



STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("secret scans", without_secrets),
    ("mixing to target weights", to_weights),
    ("SentencePiece encoding", to_ids),
]

# Trained and drawn numbers are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
