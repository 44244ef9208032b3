"""Train on the train split, score everything, report on validation and test."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textward.operators import evaluate as ev
from textward.operators import models
from textward.operators.tfidf import Tfidf, TfidfModel
from textward.sources.store import materialize


@dataclass(frozen=True)
class TrainedTfidf:
    vectorizer: TfidfModel
    classifier: LogisticRegressionModel

    def score(self, df: DataFrame, *, id_col: str, text_col: str = "text") -> DataFrame:
        with_features = self.vectorizer.vectors(
            df, id_col=id_col, text_col=text_col, out_col="features"
        )
        return models.positive_score(self.classifier, with_features).drop("features")


def train_tfidf_logreg(
    splits: DataFrame,
    *,
    id_col: str,
    vectorizer: Tfidf = Tfidf(),
    c: float = 1.0,
    max_iter: int = 1000,
) -> TrainedTfidf:
    """Fit vocabulary and classifier on the rows with ``split = 'train'``.

    Features are written once, since the solver reads them in every iteration.
    """
    train = splits.where(F.col("split") == "train").select(id_col, "text", "label")
    fitted = vectorizer.fit(train, id_col=id_col)
    features = fitted.vectors(train, id_col=id_col).select("features", F.col("label").cast("double"))
    classifier = models.train_logreg(materialize(features, "tfidf-features"), c=c, max_iter=max_iter)
    return TrainedTfidf(fitted, classifier)


def train_embedding_boosted(
    splits: DataFrame, *, embedding_col: str = "embedding", **options
) -> GBTClassificationModel:
    """Boosted trees on embeddings; the validation split decides when to stop."""
    used = splits.where(F.col("split").isin("train", "val")).select(
        as_vector(embedding_col).alias("features"),
        F.col("label").cast("double").alias("label"),
        (F.col("split") == "val").alias("is_val"),
    )
    return models.train_boosted(
        materialize(used, "embedding-features"), validation_col="is_val", **options
    )


def as_vector(embedding_col: str):
    return array_to_vector(F.transform(F.col(embedding_col), lambda x: x.cast("double")))


def held_out_report(
    splits: DataFrame, score: Callable[[DataFrame], DataFrame], *, threshold: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """Metrics per held-out split and F1 per source on the test rows."""
    held_out = splits.where(F.col("split").isin("val", "test"))
    scored = materialize(
        score(held_out).select("split", "source", "label", "score"), "held-out-scores"
    )
    predicted = scored.withColumn("pred", (F.col("score") >= threshold).cast("int"))
    per_source = ev.per_source_f1(
        predicted.where(F.col("split") == "test"), true_col="label", pred_col="pred"
    )
    return models.split_report(scored, threshold=threshold), per_source
