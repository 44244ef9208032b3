"""Binary classification metrics. Everything is a count, so one partial aggregate serves it all.

Metrics that need scores come from one additive table, a row per group, model and distinct score
(`score_counts`): its cells, the area under its curve, and its sums over days or shards alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.operators.ordered import bucketed_counts, exact_quantiles, running_totals


def _ratio(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def _cells(true_col: str, pred_col: str, prefix: str = "") -> list[Column]:
    y, p = F.col(true_col), F.col(pred_col)
    return [
        F.count_if((y == 1) & (p == 1)).alias(f"{prefix}tp"),
        F.count_if((y == 0) & (p == 1)).alias(f"{prefix}fp"),
        F.count_if((y == 1) & (p == 0)).alias(f"{prefix}fn"),
        F.count_if((y == 0) & (p == 0)).alias(f"{prefix}tn"),
    ]


def _f1(prefix: str = "") -> Column:
    tp, fp, fn = (F.col(prefix + c) for c in ("tp", "fp", "fn"))
    return _ratio(2 * tp, 2 * tp + fp + fn)


def confusion_matrix(df: DataFrame, *, true_col: str, pred_col: str) -> DataFrame:
    """All four cells in long form, zeros included."""
    return df.agg(*_cells(true_col, pred_col)).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(c).alias("count")
                    )
                    for t, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
                ]
            )
        )
    )


_COUNTS = ("tp", "fp", "fn", "tn", "pos", "neg")


def score_counts(
    df: DataFrame,
    models: dict[str, tuple[str | None, str]],
    *,
    true_col: str,
    by: list[str] | None = None,
) -> DataFrame:
    """Counts per group, model and distinct score: ``<by>, model, score, tp, fp, fn, tn, pos, neg``.

    ``models`` maps a name to its prediction (or None) and score columns. All models are counted in
    one read; tables of several days add up by grouping again. ``pos`` and ``neg`` rank by score and
    leave out rows without one, the cells don't.
    """
    by = list(by or [])
    none = F.lit(None).cast("int")
    each = [
        F.struct(
            F.lit(name).alias("model"),
            (F.col(pred) if pred else none).alias("_pred"),
            F.col(score).alias("score"),
        )
        for name, (pred, score) in models.items()
    ]
    groups = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    long = df.select(*groups, F.col(true_col).alias("_true"), F.inline(F.array(*each)))
    ranked, y = F.col("score").isNotNull(), F.col("_true")
    counts = long.groupBy(*[f"_by{i}" for i in range(len(by))], "model", "score").agg(
        *_cells("_true", "_pred"),
        F.count_if(ranked & (y == 1)).alias("pos"),
        F.count_if(ranked & (y == 0)).alias("neg"),
    )
    return counts.toDF(*by, "model", "score", *_COUNTS)


def metrics_of_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    """f1, precision, recall (0 when undefined), accuracy and auroc per group of `score_counts`.

    The area counts pairs exactly, ties half: positives at a score times negatives below it, in
    decimals; it is null when a class is missing.
    """
    run = running_totals(bucketed_counts(counts, "score"), "score", ["pos", "neg"], by)
    wide = "decimal(19,0)"
    twice_won = F.sum(
        F.col("pos").cast(wide) * (2 * F.col("neg_upto") - F.col("neg")).cast(wide)
    ).cast("double")
    pairs = (F.max("pos_all").cast(wide) * F.max("neg_all").cast(wide)).cast("double")
    cells = [F.sum(c).alias(c) for c in _COUNTS[:4]]
    summed = run.groupBy(*by).agg(*cells, F.try_divide(twice_won, 2 * pairs).alias("auroc"))
    return summed.select(*by, *_rates(), "auroc")


def _rates() -> list[Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        _f1().alias("f1"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    ]


def model_metrics(
    df: DataFrame,
    models: dict[str, tuple[str | None, str]],
    *,
    true_col: str,
    by: list[str] | None = None,
) -> DataFrame:
    """Metrics of several models per group, ``<by>, model, f1, ..., auroc``, from one read."""
    by = list(by or [])
    counts = score_counts(df, models, true_col=true_col, by=by)
    return metrics_of_counts(counts, [*by, "model"])


def auroc(
    df: DataFrame, *, true_col: str, score_col: str, by: list[str] | None = None
) -> DataFrame:
    """Area under the ROC curve with ties counted half; null when a class is missing."""
    by = list(by or [])
    scored = df.where(F.col(score_col).isNotNull())
    counts = score_counts(scored, {"": (None, score_col)}, true_col=true_col, by=by)
    return metrics_of_counts(counts.drop("model"), by).select(*by, "auroc")


def binary_metrics(
    df: DataFrame,
    *,
    true_col: str,
    pred_col: str,
    score_col: str | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """f1, precision, recall (0 when undefined), accuracy, and auroc when scores are given."""
    by = list(by or [])
    if score_col is None:
        return df.groupBy(*by).agg(*_cells(true_col, pred_col)).select(*by, *_rates())
    counts = score_counts(df, {"": (pred_col, score_col)}, true_col=true_col, by=by)
    return metrics_of_counts(counts.drop("model"), by)


def per_source_f1(
    df: DataFrame, *, true_col: str, pred_col: str, source_col: str = "source"
) -> DataFrame:
    return df.groupBy(source_col).agg(*_cells(true_col, pred_col)).select(source_col, _f1().alias("f1"))


def per_source_f1_models(
    df: DataFrame,
    models: dict[str, str],
    *,
    true_col: str,
    source_col: str = "source",
    min_rows: int = 5,
) -> DataFrame:
    """F1 per source for several models; ``models`` maps a model name to its prediction column."""
    cells = [c for name, col in models.items() for c in _cells(true_col, col, f"{name}_")]
    return (
        df.groupBy(source_col)
        .agg(F.count("*").alias("n"), *cells)
        .where(F.col("n") >= min_rows)
        .select(
            source_col,
            "n",
            *[F.round(_f1(f"{name}_"), 3).alias(f"{name}_f1") for name in models],
        )
    )


def classification_report(df: DataFrame, *, true_col: str, pred_col: str) -> DataFrame:
    """Per-class, accuracy, macro and weighted rows: ``class, precision, recall, f1, support``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    # Seen from class 0, negatives found are hits and the two kinds of error trade places.
    classes = {
        "0": (_ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fp + fn), tn + fp),
        "1": (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn), tp + fn),
    }

    def row(name: str, values: tuple, support: Column) -> Column:
        p, r, f = values
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            support.alias("support"),
        )

    acc = _ratio(tp + tn, total)
    zero, one = classes["0"], classes["1"]
    macro = tuple((a + b) / 2 for a, b in zip(zero[:3], one[:3]))
    weighted = tuple(_ratio(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3]))
    rows = [
        row("0", zero[:3], zero[3]),
        row("1", one[:3], one[3]),
        row("accuracy", (acc, acc, acc), total),
        row("macro avg", macro, total),
        row("weighted avg", weighted, total),
    ]
    return df.agg(*_cells(true_col, pred_col)).select(F.inline(F.array(*rows)))


def compare_models(metrics: DataFrame, models: list[str], digits: int = 4) -> DataFrame:
    """Long ``model, metric, value`` rows to one row per metric and one column per model."""
    wide = metrics.groupBy("metric").pivot("model", models).agg(F.first("value"))
    return wide.select("metric", *[F.round(F.col(m), digits).alias(m) for m in models])


def latency_summary(
    df: DataFrame, latency_col: str = "latency_ms", by: list[str] | None = None
) -> DataFrame:
    """Exact p50, p95, p99 (linear) and mean of per-request latencies."""
    return exact_quantiles(
        df,
        latency_col,
        {
            "p50_ms": (0.5, "linear"),
            "p95_ms": (0.95, "linear"),
            "p99_ms": (0.99, "linear"),
            "mean_ms": "mean",
        },
        by=by,
    )


def request_latency(
    df: DataFrame, *, batch_ms: str, batch_size: str, out_col: str = "latency_ms"
) -> DataFrame:
    """Latency per request of a timed batch."""
    return df.withColumn(out_col, F.col(batch_ms) / F.col(batch_size))
