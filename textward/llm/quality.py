"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text gives counts (bytes, letters, symbols, words, repeated words, lines, ...). Their rates,
drawn towards the corpus's rates so that a short text doesn't look extreme, are transformed by
square root or logarithm. Each class has its mean and its covariance, shrunk towards a multiple of
the identity; its Cholesky factor is computed once. A text's score is the posterior of class 1 from
the difference of the two Gaussian log densities (Mahalanobis distances by forward substitution).

Fitting reads all labelled rows: classes' counts, sums and sums of products are one aggregate, and
only those few numbers come to the driver.

Defined results: a null text counts as empty and gets a score like any other; rows without a label
of 0 or 1 don't take part in fitting; repeated rows count repeatedly; with fewer than two rows of a
class, or no label at all, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = (
    "bytes", "letters", "capitals", "digits", "symbols", "stops", "spaces", "newlines",
    "words", "short_words", "repeats", "distinct", "top_word", "lines", "repeated_lines",
)
# A rate's count, the count it is a share of, and the weight of the corpus's rate in units of that.
_RATES = (
    ("capitals", "letters", 100),
    ("digits", "bytes", 100),
    ("symbols", "bytes", 100),
    ("stops", "bytes", 100),
    ("spaces", "bytes", 100),
    ("newlines", "bytes", 100),
    ("short_words", "words", 20),
    ("repeats", "words", 20),
    ("top_word", "words", 20),
    ("repeated_lines", "lines", 4),
)
_N_FEATURES = len(_RATES) + 4
_STOPS = np.frombuffer(b".,;:'\"?-", np.uint8)


def count_statistics(text: str) -> list[int]:
    raw = text.encode()
    n = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    capitals, small, digits = int(n[65:91].sum()), int(n[97:123].sum()), int(n[48:58].sum())
    stops = int(n[_STOPS].sum())
    symbols = int(n[33:127].sum()) - capitals - small - digits - stops
    words = text.split()
    kinds = Counter(words)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    return [
        len(raw),
        capitals + small,
        capitals,
        digits,
        symbols,
        stops,
        int(n[32] + n[9:14].sum()),
        int(n[10]),
        len(words),
        sum([len(w) <= 3 for w in words]),
        sum(map(eq, words, words[1:])),
        len(kinds),
        max(kinds.values(), default=0),
        len(lines),
        len(lines) - len(set(lines)),
    ]


def statistics(text: Column | str) -> Column:
    """``array<bigint>``: the ``STATISTICS`` of each whole text; null counts as empty."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = [count_statistics(t or "") for t in column.to_pylist()]
            yield pa.array(rows, pa.list_(pa.int64()))

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<bigint>")(text)


def _stat(stats: Column, name: str) -> Column:
    return F.element_at(stats, STATISTICS.index(name) + 1).cast("double")


def features(stats: Column, rates: dict[str, float]) -> list[Column]:
    """Transformed statistics, given the corpus's rates."""
    out = [
        F.sqrt((_stat(stats, x) + w * rates[x]) / (_stat(stats, of) + w)) for x, of, w in _RATES
    ]
    words, size = _stat(stats, "words"), _stat(stats, "bytes")
    return out + [
        F.log1p(words + 20),
        F.log((size + 20 * rates["word_bytes"]) / (words + 20)),
        F.log((_stat(stats, "distinct") + 20) / (words + 20)),
        F.log((words + 4 * rates["line_words"]) / (_stat(stats, "lines") + 4)),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Class means and factors; ``solve[k] @ (x - mean[k])`` is whitened."""

    prior: float
    rates: dict[str, float]
    mean: np.ndarray
    factor: np.ndarray
    offset: np.ndarray

    @property
    def fitted(self) -> bool:
        return len(self.mean) == 2

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, priors included."""
        density = []
        for mean, factor, offset in zip(self.mean, self.factor, self.offset):
            white = np.linalg.solve(factor, (x - mean).T)
            density.append(offset - 0.5 * (white**2).sum(axis=0))
        return density[1] - density[0]


def fit(rows: DataFrame, *, stats_col: str, label_col: str, shrinkage: float = 0.01) -> Discriminant:
    """Fit on the rows whose label is 0 or 1."""
    known = rows.where(F.col(label_col).isin(0, 1)).select(
        F.col(stats_col).alias("s"), F.col(label_col).cast("int").alias("y")
    )
    totals = known.agg(
        F.count("*").alias("n"),
        F.sum("y").alias("ones"),
        *[F.sum(_stat(F.col("s"), x)).alias(x) for x in STATISTICS],
    ).first()
    n, ones = totals["n"], totals["ones"] or 0
    share = lambda x, of: (totals[x] or 0.0) / max(totals[of] or 0.0, 1.0)
    rates = {x: share(x, of) for x, of, _ in _RATES}
    rates |= {"word_bytes": share("bytes", "words"), "line_words": share("words", "lines")}
    if min(ones, n - ones) < 2:
        return Discriminant(ones / n if n else 0.5, rates, *[np.empty(0)] * 3)
    d = _N_FEATURES
    at = [(i, j) for i in range(d) for j in range(i, d)]
    wide = known.select("y", *[f.alias(f"f{i}") for i, f in enumerate(features(F.col("s"), rates))])
    sums = {
        r["y"]: r
        for r in wide.groupBy("y")
        .agg(
            F.count("*").alias("n"),
            F.array(*[F.sum(f"f{i}") for i in range(d)]).alias("x"),
            F.array(*[F.sum(F.col(f"f{i}") * F.col(f"f{j}")) for i, j in at]).alias("xx"),
        )
        .collect()
    }
    counts = {y: r["n"] for y, r in sums.items()}
    means = {y: np.array(r["x"]) / r["n"] for y, r in sums.items()}
    spread = {}
    for y, r in sums.items():
        c = np.zeros((d, d))
        for (i, j), v in zip(at, r["xx"]):
            c[i, j] = c[j, i] = v / r["n"]
        spread[y] = c - np.outer(means[y], means[y])
    # Features are scaled by their pooled deviation, so that one shrinkage suits them all.
    pooled = sum(counts[y] * np.diag(spread[y]) for y in (0, 1)) / n
    scale = np.sqrt(np.maximum(pooled, 1e-12))
    factors, offsets = [], []
    for y in (0, 1):
        c = spread[y] / np.outer(scale, scale)
        c = (1 - shrinkage) * c + shrinkage * max(np.trace(c) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky(c)
        factors.append(scale[:, None] * factor)
        offsets.append(np.log(counts[y] / n) - np.log(np.diag(factor)).sum())
    return Discriminant(
        ones / n, rates, np.stack([means[0], means[1]]), np.stack(factors), np.array(offsets)
    )


def score(stats: Column, model: Discriminant) -> Column:
    """Probability of label 1, between 0 and 1."""
    if not model.fitted:
        return F.lit(float(model.prior))

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
            odds = model.log_odds(x)
            yield pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")(F.array(*features(stats, model.rates)))
