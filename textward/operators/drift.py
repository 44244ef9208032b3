"""Drift between production and training text, for all model families in one job.

Each side is read once and reduced to counts and sums before anything is compared; only these
small tables are joined.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.functions.pvalues import chi2_p_value, ks_exact_p_value, ks_p_value
from textward.functions.text import CYRILLIC, char_features
from textward.operators.ordered import integer_bucket, running_totals
from textward.sources.store import materialize

# Verdict thresholds and guards.
LENGTH_THRESHOLD = 0.01
CHARSET_THRESHOLD = 0.01
COSINE_THRESHOLD = 0.15
MIN_TEST_ROWS = 5
MIN_PRODUCTION_ROWS = 100
# Bin edges of the script share; the last bin includes 1.
CHARSET_EDGES = (0.0, 0.25, 0.5, 0.75, 1.01)

# The family that rows without one are counted under.
NO_FAMILY = "unknown"

_BINS = len(CHARSET_EDGES) - 1


def _family(family_col: str) -> Column:
    return F.coalesce(F.col(family_col).cast("string"), F.lit(NO_FAMILY)).alias("family")


def family_names(production: DataFrame, family_col: str = "family") -> list[str]:
    """The families present; a model family is configuration, so there are only a few."""
    return sorted(r[0] for r in production.select(_family(family_col)).distinct().collect())


def _per_length(
    side: DataFrame, by: list[Column], script: str, text_col: str
) -> DataFrame:
    """Sums per ``by`` and text length: rows, letters, script characters, digits, charset bins.

    Everything the tests need is additive, so this one pass over the text serves all of them, and
    its result has a row per distinct length.
    """
    feats = char_features(text_col, script)
    rows = side.select(*by, feats.alias("f")).select("*", F.col("f")[0].cast("int").alias("chars"))
    share = F.coalesce(F.try_divide(F.col("f")[2], F.col("f")[0]), F.lit(0.0))
    rows = rows.withColumn("r", share)
    edges = zip(CHARSET_EDGES[:-1], CHARSET_EDGES[1:])
    return rows.groupBy(*[c for c in rows.columns if c not in ("f", "r")]).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col("f")[i]).alias(f"s{i}") for i in range(4)],
        *[
            F.count_if((F.col("r") >= lo) & (F.col("r") < hi)).alias(f"b{i}")
            for i, (lo, hi) in enumerate(edges)
        ],
    )


def _totals(per_length: DataFrame, by: list[str]) -> DataFrame:
    """Rows, charset bins and mean character features of a side."""
    n = F.sum("n")
    return per_length.groupBy(*by).agg(
        n.alias("n"),
        F.array(*[F.sum(f"b{i}") for i in range(_BINS)]).alias("bins"),
        F.array(*[F.sum(f"s{i}") / n for i in range(4)]).alias("centroid"),
    )


def _for_every(families: list[str]) -> Column:
    return F.explode(F.array(*[F.lit(f) for f in families])).alias("family")


def _largest_gap(prod: DataFrame, train: DataFrame, families: list[str]) -> DataFrame:
    """``family, ks_d`` from counts ``n`` per family and length, and per length."""
    none = F.lit(0).cast("bigint")
    counts = (
        prod.select("family", "chars", F.col("n").alias("p"), none.alias("t"))
        .unionAll(
            train.select(_for_every(families), "chars", none.alias("p"), F.col("n").alias("t"))
        )
        .groupBy("family", "chars")
        .agg(F.sum("p").alias("p"), F.sum("t").alias("t"))
        .withColumn("_bucket", integer_bucket("chars"))
    )
    run = running_totals(counts, "chars", ["p", "t"], ["family"])
    wide = "decimal(19,0)"

    def product(a: str, b: str) -> Column:
        return F.col(a).cast(wide) * F.col(b).cast(wide)

    gap = F.max(F.abs(product("p_upto", "t_all") - product("t_upto", "p_all"))).cast("double")
    whole = F.max(product("p_all", "t_all")).cast("double")
    return run.groupBy("family").agg(F.coalesce(F.try_divide(gap, whole), F.lit(0.0)).alias("ks_d"))


def length_statistic(
    production: DataFrame,
    training: DataFrame,
    families: list[str],
    *,
    family_col: str = "family",
    text_col: str = "text",
) -> DataFrame:
    """Two-sample KS statistic of text length per family: ``family, ks_d``.

    The largest gap between the two running shares, over counts per distinct length. The gap is
    compared in whole numbers and divided once at the end.
    """
    chars, n = F.length(text_col).alias("chars"), F.count("*").alias("n")
    prod = production.select(F.col(family_col).alias("family"), chars).groupBy("family", "chars")
    train = training.select(chars).groupBy("chars")
    return _largest_gap(prod.agg(n), train.agg(n), families)


def chi_square(p_bins: Column, t_bins: Column) -> Column:
    """Statistic of observed against scaled reference counts, expected counts floored to 1."""
    p_total = sum((p_bins[i] for i in range(1, _BINS)), p_bins[0])
    t_total = sum((t_bins[i] for i in range(1, _BINS)), t_bins[0])
    scale = F.try_divide(p_total, t_total)
    parts = []
    for i in range(_BINS):
        expected = F.greatest(t_bins[i] * scale, F.lit(1.0))
        parts.append((p_bins[i] - expected) * (p_bins[i] - expected) / expected)
    return sum(parts[1:], parts[0])


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two arrays; 0.0 when one is missing or has no length."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda u, v: u * v)
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    cos = F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return F.coalesce(F.lit(1.0) - cos, F.lit(0.0))


def centroids(df: DataFrame, vector_col: str = "embedding", by: list[str] | None = None) -> DataFrame:
    """Mean vector per group, summed map-side."""
    by = list(by or [])
    vec = array_to_vector(F.transform(F.col(vector_col), lambda x: x.cast("double")))
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(Summarizer.mean(vec).alias("_m")).select(
        *by, vector_to_array("_m").alias("centroid")
    )


def centroid_distance(
    production: DataFrame, training: DataFrame, vector_col: str = "embedding"
) -> DataFrame:
    """Cosine distance between the centroids of two embedding tables (one row)."""
    side = F.col("side")
    sides = (
        production.select(F.lit("p").alias("side"), vector_col)
        .unionAll(training.select(F.lit("t").alias("side"), vector_col))
    )
    both = centroids(sides, vector_col, ["side"]).agg(
        F.max(F.when(side == "p", F.col("centroid"))).alias("p"),
        F.max(F.when(side == "t", F.col("centroid"))).alias("t"),
    )
    return both.select(cosine_distance(F.col("p"), F.col("t")).alias("cosine_distance"))


def drift_tests(
    production: DataFrame,
    training: DataFrame,
    families: list[str] | None = None,
    *,
    family_col: str = "family",
    text_col: str = "text",
    script: str = CYRILLIC,
) -> DataFrame:
    """Statistics per family: ``family, n_production, n_training, ks_d, chi2, cosine_distance``.

    One row for each family of ``families`` or of the production side; rows without a family count
    as ``NO_FAMILY``.
    """
    # Written once, a row per distinct length; left lazy, each use would read the text again.
    prod = materialize(
        _per_length(production, [_family(family_col)], script, text_col), "drift-production"
    )
    families = sorted({*(families or []), *family_names(prod)})
    if not families:
        raise ValueError("name the families: the production side has none")
    train = materialize(_per_length(training, [], script, text_col), "drift-training")
    reference = _totals(train, []).select(
        _for_every(families),
        F.col("n").alias("n_training"),
        F.col("bins").alias("t_bins"),
        F.col("centroid").alias("t_centroid"),
    )
    none = F.array(*[F.lit(0).cast("bigint")] * _BINS)
    return (
        reference.join(_totals(prod, ["family"]), "family", "left")
        .join(_largest_gap(prod, train, families), "family", "left")
        .select(
            "family",
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n_production"),
            F.coalesce("n_training", F.lit(0)).cast("bigint").alias("n_training"),
            F.coalesce("ks_d", F.lit(0.0)).alias("ks_d"),
            chi_square(F.coalesce("bins", none), F.col("t_bins")).alias("chi2"),
            cosine_distance(F.col("centroid"), F.col("t_centroid")).alias("cosine_distance"),
        )
    )


def drift_report(
    tests: DataFrame, min_production: int = MIN_PRODUCTION_ROWS, method: str = "asymptotic"
) -> DataFrame:
    """p-values and verdict per family; too little production text means no verdict.

    ``method`` of the length test: ``"asymptotic"`` or ``"exact"``, for every size alike.
    """
    ks_p = {"asymptotic": ks_p_value, "exact": ks_exact_p_value}[method]
    enough = (F.col("n_production") >= MIN_TEST_ROWS) & (F.col("n_training") >= MIN_TEST_ROWS)
    skipped = F.col("n_production") < min_production
    one = F.lit(1.0)
    # The p-values see one row per family; sizes are raised to 1 to keep guarded rows valid.
    sizes = [F.greatest(c, F.lit(1)) for c in ("n_production", "n_training")]
    p_len = ks_p(F.col("ks_d"), *sizes)
    p_chr = chi2_p_value(F.coalesce("chi2", F.lit(0.0)))
    verdict = (
        (F.col("p_value_length") < LENGTH_THRESHOLD)
        | (F.col("p_value_charset") < CHARSET_THRESHOLD)
        | (F.col("cosine_distance") > COSINE_THRESHOLD)
    )
    return (
        tests.withColumns({"_pl": p_len, "_pc": p_chr})
        .select(
            "family",
            F.when(skipped | ~enough, one).otherwise(F.col("_pl")).alias("p_value_length"),
            F.when(skipped | ~enough | F.col("chi2").isNull(), one)
            .otherwise(F.col("_pc"))
            .alias("p_value_charset"),
            F.when(skipped, F.lit(0.0)).otherwise(F.col("cosine_distance")).alias("cosine_distance"),
            "n_production",
            "n_training",
            F.when(skipped, "insufficient_samples").alias("skipped_reason"),
        )
        .withColumn("drift_detected", F.col("skipped_reason").isNull() & verdict)
    )


def detect_drift(
    production: DataFrame,
    training: DataFrame,
    families: list[str] | None = None,
    *,
    family_col: str = "family",
    text_col: str = "text",
    script: str = CYRILLIC,
    min_production: int = MIN_PRODUCTION_ROWS,
    method: str = "asymptotic",
) -> DataFrame:
    """Drift report with one row per family named or found in production."""
    tests = drift_tests(
        production, training, families, family_col=family_col, text_col=text_col, script=script
    )
    return drift_report(tests, min_production, method)


def drift_gauge(report: DataFrame, ts: Column) -> DataFrame:
    """The report as gauge samples ``ts, family, value`` to append to the metric table."""
    return report.select(
        ts.alias("ts"), "family", F.col("drift_detected").cast("double").alias("value")
    )

