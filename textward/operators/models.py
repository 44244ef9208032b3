"""Baseline classifiers, batched scoring with any model, pooled embeddings, prediction records."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from textward.functions.text import decode_confidence, decode_label
from textward.operators import evaluate as ev
from textward.sources.store import materialize


def train_logreg(
    train: DataFrame,
    *,
    features_col: str = "features",
    label_col: str = "label",
    c: float = 1.0,
    max_iter: int = 1000,
) -> LogisticRegressionModel:
    """L2 logistic regression with a free intercept.

    Spark minimises the mean loss, so an inverse strength ``c`` on the summed loss is
    ``1 / (c * n)`` here.
    """
    return LogisticRegression(
        featuresCol=features_col,
        labelCol=label_col,
        regParam=1.0 / (c * train.count()),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    ).fit(train)


@dataclass(frozen=True)
class FewFeatureLogit:
    """Logistic regression over number columns; ``weights`` ends with the intercept."""

    features: tuple[str, ...]
    weights: tuple[float, ...]

    def margin(self) -> Column:
        terms = [F.col(f) * F.lit(w) for f, w in zip(self.features, self.weights)]
        return sum(terms, F.lit(self.weights[-1]))

    def score(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        """``df`` plus the probability of the positive class, null where a feature is."""
        return df.withColumn(out_col, 1.0 / (1.0 + F.exp(-self.margin())))


def train_newton(
    df: DataFrame,
    features: Sequence[str],
    *,
    label_col: str = "label",
    c: float = 1.0,
    max_steps: int = 50,
    tolerance: float = 1e-10,
) -> FewFeatureLogit:
    """The optimum of `train_logreg` for a few number columns, by Newton steps.

    A step is one aggregate of plain columns: the loss, its gradient and the weighted products of
    all pairs of features, sums that add up over tasks. The driver sees these numbers only. Their
    count is the square of the features', so this is for tens of them. Rows with a null or NaN are
    left out; a step that raises the loss is halved.
    """
    names = [f"x{i}" for i in range(len(features))]
    columns = [F.col(f).cast("double").alias(n) for f, n in zip(features, names)]
    rows = df.select(*columns, F.col(label_col).cast("double").alias("y"))
    for name in [*names, "y"]:
        rows = rows.where(F.col(name).isNotNull() & ~F.isnan(name))
    rows = materialize(rows, "newton-rows")
    size = len(names) + 1
    x = [*[F.col(n) for n in names], F.lit(1.0)]
    ridge = np.array([1.0 / c] * len(names) + [0.0])
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        margin = sum((x[i] * F.lit(float(w[i])) for i in range(size - 1)), F.lit(float(w[-1])))
        p, z, y = F.col("p"), F.col("z"), F.col("y")
        at = rows.withColumn("z", margin).withColumn("p", 1.0 / (1.0 + F.exp(-z)))
        loss = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
        got = at.agg(
            F.sum(loss),
            *[F.sum(x[i] * (p - y)) for i in range(size)],
            *[F.sum(x[i] * x[j] * p * (1.0 - p)) for i, j in pairs],
        ).first()
        if got[0] is None:
            raise ValueError("no rows to train on")
        square = np.diag(ridge)
        for (i, j), v in zip(pairs, got[1 + size :]):
            square[i, j] += v
            square[j, i] = square[i, j]
        return got[0] + float(ridge @ (w * w)) / 2, np.array(got[1 : 1 + size]) + ridge * w, square

    w, step, last = np.zeros(size), np.zeros(size), np.inf
    for _ in range(max_steps):
        loss, gradient, square = sums(w)
        if loss > last + 1e-9 * abs(last):
            step = step / 2
            w = w - step
            continue
        last = loss
        step = -np.linalg.lstsq(square, gradient, rcond=None)[0]
        w = w + step
        if np.abs(step).max() < tolerance:
            return FewFeatureLogit(tuple(features), tuple(float(v) for v in w))
    raise ValueError(f"no optimum within {max_steps} steps; is one class missing?")


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of rounds with the least loss so far once ``patience`` rounds brought none lower.

    The flag tells whether the rounds ran out of patience.
    """
    best = 0
    for at, loss in enumerate(losses):
        if loss < losses[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def _first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble's first ``n`` trees as a model of their own."""
    trees, weights = model._java_obj.trees(), model._java_obj.treeWeights()
    sc = SparkContext._active_spark_context
    tree_class = sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    some = sc._gateway.new_array(tree_class, n)
    weighed = sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        some[i], weighed[i] = trees[i], weights[i]
    java = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, some, weighed
    )
    return model._copyValues(GBTClassificationModel(java))


def train_boosted(
    df: DataFrame,
    *,
    validation_col: str,
    features_col: str = "features",
    label_col: str = "label",
    rounds: int = 200,
    learning_rate: float = 0.05,
    max_depth: int = 5,
    min_rows_per_leaf: int = 5,
    patience: int = 20,
    seed: int = 42,
) -> GBTClassificationModel:
    """Gradient-boosted trees that stop early on the rows flagged by ``validation_col``.

    Trees grow level by level; depth 5 has 32 leaves, next to the 31 of a leaf-wise learner. The
    model ends at the round with the least log loss on the flagged rows, as soon as ``patience``
    rounds brought no lower one. A longer fit repeats the trees of a shorter one, so fits of
    doubled length (from twice the patience) find that round in at most about twice its work.
    Without flagged rows all rounds are kept.
    """
    flagged = F.coalesce(F.col(validation_col), F.lit(False))
    train, held_out = df.where(~flagged), df.where(flagged)
    measured = not held_out.isEmpty()
    n = min(rounds, 2 * patience) if measured else rounds
    while True:
        model = GBTClassifier(
            featuresCol=features_col,
            labelCol=label_col,
            maxIter=n,
            stepSize=learning_rate,
            maxDepth=max_depth,
            minInstancesPerNode=min_rows_per_leaf,
            seed=seed,
        ).fit(train)
        if not measured:
            return model
        best, stopped = best_round(model.evaluateEachIteration(held_out), patience)
        if stopped or n >= rounds:
            return _first_trees(model, best)
        n = min(rounds, 2 * n)


def positive_score(
    model: LogisticRegressionModel | GBTClassificationModel, df: DataFrame, out_col: str = "score"
) -> DataFrame:
    """``df`` plus the probability of the positive class."""
    scored = model.transform(df)
    return scored.select(
        *df.columns, vector_to_array(F.col(model.getProbabilityCol()))[1].alias(out_col)
    )


def score_batches(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[Sequence[str]], Sequence]],
    *,
    text_col: str = "text",
    out_col: str = "score",
    returns: str = "double",
    batch_size: int = 32,
) -> DataFrame:
    """Score texts with any model or encoder.

    ``make_scorer`` runs once per task (load the model there) and returns a function from a list
    of texts to as many results. Only the text column travels to Python.
    """

    kind = to_arrow_type(DataType.fromDDL(returns))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = make_scorer()
        for column in columns:
            parts = [pa.array([], kind)]
            for at in range(0, len(column), batch_size):
                # Only these texts are Python objects at a time.
                out = list(scorer(column.slice(at, batch_size).to_pylist()))
                parts.append(pa.array(out, kind, from_pandas=True))
            yield pa.concat_arrays(parts)

    score.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(out_col, F.arrow_udf(score, returns)(F.col(text_col)))


def mean_pool(
    tokens: DataFrame, *, id_col: str, vector_col: str = "vector", mask_col: str = "mask"
) -> DataFrame:
    """Mean of each id's unmasked token vectors; all-masked ids get a zero vector.

    The sums are formed map-side, so a text with very many tokens is no hot group.
    """
    masked = F.transform(
        F.col(vector_col), lambda x: x.cast("double") * F.col(mask_col).cast("double")
    )
    pooled = tokens.groupBy(id_col).agg(
        Summarizer.sum(array_to_vector(masked)).alias("_sum"),
        F.sum(F.col(mask_col).cast("bigint")).alias("_n"),
    )
    n = F.greatest(F.col("_n"), F.lit(1))
    return pooled.select(
        id_col, F.transform(vector_to_array("_sum"), lambda x: x / n).alias("embedding")
    )


def prediction_records(
    scored: DataFrame, *, family: str, model_version: str, data_version: str, score_col: str = "score"
) -> DataFrame:
    """Decoded label and confidence plus the model's identity; works on batches and streams."""
    return scored.select(
        *[c for c in scored.columns if c != score_col],
        decode_label(score_col).alias("label"),
        decode_confidence(score_col).alias("confidence"),
        F.lit(family).alias("model_family"),
        F.lit(model_version).alias("model_version"),
        F.lit(data_version).alias("data_version"),
    )


def split_report(
    scored: DataFrame,
    *,
    label_col: str = "label",
    score_col: str = "score",
    split_col: str = "split",
    threshold: float = 0.5,
) -> DataFrame:
    """Binary metrics on the validation and test rows."""
    held_out = scored.where(F.col(split_col).isin("val", "test")).withColumn(
        "_pred", (F.col(score_col) >= threshold).cast("int")
    )
    return ev.binary_metrics(
        held_out, true_col=label_col, pred_col="_pred", score_col=score_col, by=[split_col]
    )
