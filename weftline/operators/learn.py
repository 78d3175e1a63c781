"""Logistic regression and text classification with Spark ML pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_logistic(
    training: DataFrame, max_iter: int = 10, reg: float = 0.01, overrides: dict[str, object] | None = None
) -> LogisticRegressionModel:
    """Fit on ``(label, features)``; ``overrides`` apply to this fit only and win."""
    estimator = LogisticRegression(maxIter=max_iter, regParam=reg)
    params = {estimator.getParam(name): value for name, value in (overrides or {}).items()}
    return estimator.fit(training, params) if params else estimator.fit(training)


def merged(*settings: dict[str, object]) -> dict[str, object]:
    """Parameter maps joined in order; a later map wins."""
    out: dict[str, object] = {}
    for setting in settings:
        out.update(setting)
    return out


def text_stages(num_features: int = 1000) -> list:
    """Lower-case whitespace tokens, then hashed term frequencies."""
    words = Tokenizer(inputCol="text", outputCol="words")
    return [words, HashingTF(inputCol="words", outputCol="features", numFeatures=num_features)]


def text_classifier(num_features: int = 1000, max_iter: int = 10, reg: float = 0.001) -> Pipeline:
    return Pipeline(stages=[*text_stages(num_features), LogisticRegression(maxIter=max_iter, regParam=reg)])


def hashed_terms(docs: DataFrame, num_features: int = 1000) -> DataFrame:
    """Token and hashed-frequency columns; both stages only transform."""
    for stage in text_stages(num_features):
        docs = stage.transform(docs)
    return docs


def positive_share(scored: DataFrame, column: str = "probability") -> DataFrame:
    """Add ``p1``, the probability of class 1, as a plain column."""
    return scored.withColumn("p1", F.get(vector_to_array(column), F.lit(1)))


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
