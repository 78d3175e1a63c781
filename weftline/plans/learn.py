"""ML queries: document quality from text, order urgency from line totals."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weftline.operators import certify
from weftline.operators import learn as L
from weftline.plans.registry import query
from weftline.session import scratch_path, staged
from weftline.sources.tables import table, widened


def order_vectors(spark, d):
    """Orders with label (large) and vector (lines, quantity)."""
    lines = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )
    orders = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 250000).cast("double").alias("label")
    )
    return VectorAssembler(inputCols=["n_lines", "quantity"], outputCol="features").transform(orders.join(lines, "o_orderkey"))


@query("logreg_predict")
def logreg_predict(spark, d):
    """Large orders from line count and quantity, with per-fit overrides."""
    vectors = order_vectors(spark, d)
    # The settings that the results depend on.
    overrides = L.merged({"maxIter": 20}, {"maxIter": 30}, {"regParam": 0.1, "threshold": 0.55}, {"probabilityCol": "p_large"})
    model = L.fit_logistic(vectors.select("label", "features"), overrides=overrides)
    scored = L.positive_share(model.transform(vectors), "p_large")
    return scored.select("o_orderkey", "label", F.round("p1", 6).alias("p1"), "prediction")


@query("text_classifier_predict")
def text_classifier_predict(spark, d):
    """Quality of every document, learned from the labelled ones."""
    docs = widened(table(spark, d, "documents").select("doc_id", "text"))
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = L.text_classifier().fit(docs.join(labels, "doc_id"))
    scored = L.positive_share(model.transform(docs))
    return scored.select("doc_id", F.round("p1", 6).alias("p1"), "prediction")


@query(
    "tokenize_hash_tf",
    r"""SELECT doc_id, len(toks) AS n_tokens, len(toks)::DOUBLE AS tf_total FROM (
          SELECT doc_id, string_split_regex(
            rtrim(lower(text), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '\s') AS toks
          FROM documents)""",
)
def tokenize_hash_tf(spark, d):
    """Tokens per document; hashing loses no term, so the frequencies sum to the token count."""
    terms = L.hashed_terms(widened(table(spark, d, "documents").select("doc_id", "text")))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda acc, x: acc + x)
    return terms.select("doc_id", F.size("words").cast("bigint").alias("n_tokens"), total.alias("tf_total"))


def prediction_form(scored, key, threshold):
    """Per row: how often it was scored, whether its probability is one, and whether the prediction follows from it."""
    p = F.col("p1")
    agrees = F.col("prediction") == (p > threshold).cast("double")
    return scored.groupBy(key).agg(
        F.count("*").alias("n_scored"), F.every((p >= 0) & (p <= 1)).alias("is_probability"),
        # A probability at the threshold, as far as it is printed, may go either way.
        F.every(agrees | (F.abs(p - threshold) < 1e-6)).alias("agrees"))


@query("text_classifier_form", "SELECT doc_id, count(*) AS n_scored, true AS is_probability, true AS agrees FROM documents GROUP BY doc_id")
def text_classifier_form(spark, d):
    return prediction_form(text_classifier_predict(spark, d), "doc_id", 0.5)


@query(
    "logreg_form",
    """SELECT o_orderkey, 1::BIGINT AS n_scored, true AS is_probability, true AS agrees
       FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def logreg_form(spark, d):
    return prediction_form(logreg_predict(spark, d), "o_orderkey", 0.55)


# A fit that ends at the optimum, not after a number of steps.
CONVERGED = {"maxIter": 200, "tol": 1e-12}
SLOPE = 1e-4


def certified(spark, model, rows, key, reg):
    """Rows with the model's and the recomputed probability, and the slopes of the loss at its weights."""
    weights = certify.exported_weights(spark, model.coefficients)
    terms = staged(certify.term_rows(rows, "features", key), "terms")
    p = certify.recomputed_probability(terms, weights, model.intercept, key)
    # A row without any feature has the intercept alone.
    bare = 1 / (1 + F.exp(-F.lit(model.intercept)))
    scored = L.positive_share(model.transform(rows)).select(key, "label", "p1").join(p, key, "left").withColumn("p", F.coalesce("p", bare))
    scored = staged(scored, "scored")
    return scored, certify.logistic_gradient(terms, scored.select(key, "label", "p"), weights, reg)


@query(
    "logreg_certificate",
    """SELECT o_orderkey, true AS recomputed, true AS optimal FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def logreg_certificate(spark, d):
    """The model's probabilities follow from its weights, and at these weights the loss over all orders has no slope."""
    vectors = staged(order_vectors(spark, d).select("o_orderkey", "label", "features"), "vectors")
    model = L.fit_logistic(vectors.select("label", "features"), overrides=L.merged(CONVERGED, {"regParam": 0.1}))
    scored, slopes = certified(spark, model, vectors, "o_orderkey", 0.1)
    steepest = slopes.agg(F.max(F.abs("scaled"))).first()[0]
    return scored.select("o_orderkey", (F.abs(F.col("p1") - F.col("p")) < 1e-9).alias("recomputed"), F.lit(steepest < SLOPE).alias("optimal"))


@query(
    "text_classifier_certificate",
    """SELECT doc_id, true AS recomputed, true AS optimal FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL""",
)
def text_classifier_certificate(spark, d):
    """As above for quality from hashed words, over all labelled documents."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").where("quality IS NOT NULL").select("doc_id", F.col("quality").cast("double").alias("label"))
    rows = staged(L.hashed_terms(widened(docs.join(labels, "doc_id"))).select("doc_id", "label", "features"), "vectors")
    model = L.fit_logistic(rows.select("label", "features"), reg=0.001, overrides=CONVERGED)
    scored, slopes = certified(spark, model, rows, "doc_id", 0.001)
    steepest = slopes.agg(F.max(F.abs("scaled"))).first()[0]
    return scored.select("doc_id", (F.abs(F.col("p1") - F.col("p")) < 1e-9).alias("recomputed"), F.lit(steepest < SLOPE).alias("optimal"))


@query("model_reload", "SELECT doc_id, true AS same FROM documents")
def model_reload(spark, d):
    """A pipeline that was saved and loaded again predicts as before."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    labels = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = L.text_classifier().fit(docs.join(labels, "doc_id"))
    again = L.save_and_reload(model, scratch_path(spark, "model"))
    both = [L.positive_share(m.transform(docs)).select("doc_id", F.struct("p1", "prediction").alias(name)) for m, name in ((model, "a"), (again, "b"))]
    return both[0].join(both[1], "doc_id").select("doc_id", F.col("a").eqNullSafe(F.col("b")).alias("same"))
