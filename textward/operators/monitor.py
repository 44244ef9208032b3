"""Prediction monitoring: counters, bucketed histograms, trailing rates, quantiles and alerts.

Input is a prediction table ``ts, family, label, confidence, latency_s, text``. A trailing window
that moves by a step is built from tiles of one step: rows are reduced to tiles first, and only the
tiles, whose number grows with time and not with traffic, are repeated for the windows they fall in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textward.functions.text import CYRILLIC, POSITIVE, char_script_ratio, preview, token_estimate

# Upper bucket edges of the four histograms (+Inf is implied).
CONFIDENCE_EDGES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99)
LATENCY_EDGES = (0.001, 0.005, 0.010, 0.025, 0.050, 0.100, 0.250, 0.500, 1.0, 2.5)
TOKEN_EDGES = (8.0, 16.0, 32.0, 64.0, 128.0, 256.0, 512.0, 1024.0, 2048.0)
SCRIPT_EDGES = (0.1, 0.3, 0.5, 0.7, 0.9, 0.95, 1.0)

MINUTE = 60
HOUR = 3600

# Alert name -> (threshold, trailing range and hold time in seconds).
ALERTS = {
    "high_error_rate": (0.05, 5 * MINUTE, 5 * MINUTE),
    "high_latency": (0.5, 5 * MINUTE, 10 * MINUTE),
    "confidence_collapse": (0.6, HOUR, HOUR),
    "class_imbalance_high": (0.8, HOUR, HOUR),
    "class_imbalance_low": (0.05, HOUR, HOUR),
    "drift_detected": (1.0, 8 * 24 * HOUR, 5 * MINUTE),
}


def utc_timestamp(ts_ntz: Column | str) -> Column:
    """A zone-less UTC timestamp as an instant, whatever the session's time zone."""
    c = F.col(ts_ntz) if isinstance(ts_ntz, str) else ts_ntz
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, c))


def prediction_counts(df: DataFrame, width: str = "1 hour") -> DataFrame:
    """Predictions per window, family and label. Runs on a table or on a watermarked stream."""
    return (
        df.groupBy(F.window("ts", width), "family", "label")
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("window_start"), "family", "label", "count")
    )


def histogram_values(script: str = CYRILLIC) -> dict[str, tuple[tuple[float, ...], Column]]:
    """Metric name -> (edges, observed value)."""
    return {
        "confidence": (CONFIDENCE_EDGES, F.col("confidence")),
        "latency_s": (LATENCY_EDGES, F.col("latency_s")),
        "tokens": (TOKEN_EDGES, token_estimate("text")),
        "script_ratio": (SCRIPT_EDGES, char_script_ratio("text", script)),
    }


def bucket_counts(value: Column, edges: Sequence[float], prefix: str) -> dict[str, Column]:
    """Cumulative bucket counters ``<prefix>_0..`` and the +Inf bucket ``<prefix>_inf``."""
    out = {f"{prefix}_{i}": F.count_if(value <= F.lit(float(e))) for i, e in enumerate(edges)}
    return {**out, f"{prefix}_inf": F.count(value)}


def prediction_histograms(
    df: DataFrame, width: str = "1 hour", script: str = CYRILLIC
) -> DataFrame:
    """Cumulative histograms of all four metrics in long form, from one aggregate.

    ``window_start, family, metric, le, bucket, sum, count``; ``le`` is infinite in the last bucket.
    Runs on a table or on a watermarked stream.
    """
    metrics = histogram_values(script)
    aggs = [F.count("*").alias("_n")]
    for name, (edges, value) in metrics.items():
        aggs += [c.alias(n) for n, c in bucket_counts(value, edges, name).items()]
        aggs.append(F.sum(value).alias(f"{name}_sum"))
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.lit(float(le)).alias("le"),
            F.col(f"{name}_{i}").alias("bucket"),
            F.col(f"{name}_sum").alias("sum"),
            F.col(f"{name}_inf").alias("count"),
        )
        for name, (edges, _) in metrics.items()
        for i, le in [*enumerate(edges), ("inf", float("inf"))]
    ]
    return (
        df.groupBy(F.window("ts", width), "family")
        .agg(*aggs)
        .select(F.col("window.start").alias("window_start"), "family", F.inline(F.array(*rows)))
    )


def trailing_sums(
    df: DataFrame,
    sums: dict[str, Column],
    by: list[str],
    *,
    range_s: int,
    step_s: int = MINUTE,
) -> DataFrame:
    """Additive aggregates over ``[eval_ts - range, eval_ts)`` at every step with any rows."""
    if range_s % step_s:
        raise ValueError("range_s must be a multiple of step_s")
    tile_end = (F.floor(F.unix_seconds("ts") / step_s) + 1) * step_s
    tiles = df.groupBy(tile_end.alias("_tile"), *by).agg(
        *[c.alias(n) for n, c in sums.items()]
    )
    evals = F.sequence("_tile", F.col("_tile") + (range_s - step_s), F.lit(step_s).cast("bigint"))
    return (
        tiles.withColumn("_eval", F.explode(evals))
        .groupBy("_eval", *by)
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(F.timestamp_seconds("_eval").alias("eval_ts"), *by, *sums)
    )


# The functions below take the windowing as ``sums_of``: ``trailing_sums`` for a table, its
# streaming form for a stream.


def rates(
    df: DataFrame,
    by: list[str],
    *,
    range_s: int = 5 * MINUTE,
    step_s: int = MINUTE,
    sums_of: Callable[..., DataFrame] = trailing_sums,
) -> DataFrame:
    """Events per second over the trailing range."""
    sums = sums_of(df, {"_n": F.count("*")}, by, range_s=range_s, step_s=step_s)
    return sums.select("eval_ts", *by, (F.col("_n") / F.lit(float(range_s))).alias("rate"))


def bucket_quantile(q: float, cumulative: list[Column], total: Column, edges: Sequence[float]) -> Column:
    """Quantile from cumulative buckets by linear interpolation inside the bucket.

    The first bucket starts at 0. A rank beyond the last finite edge returns that edge; no
    observations give null.
    """
    rank = total * F.lit(float(q))
    result = F.lit(float(edges[-1]))
    for i in reversed(range(len(edges))):
        low = F.lit(float(edges[i - 1]) if i else 0.0)
        below = cumulative[i - 1] if i else F.lit(0)
        share = F.try_divide(rank - below, cumulative[i] - below)
        inside = low + (F.lit(float(edges[i])) - low) * share
        result = F.when(cumulative[i] >= rank, inside).otherwise(result)
    return F.when(total > 0, result)


def trailing_quantile(
    df: DataFrame,
    value: Column,
    edges: Sequence[float],
    q: float,
    *,
    by: list[str],
    range_s: int,
    step_s: int = MINUTE,
    sums_of: Callable[..., DataFrame] = trailing_sums,
) -> DataFrame:
    """Bucketed quantile over the trailing range: ``eval_ts, by, value``."""
    sums = bucket_counts(value, edges, "b")
    hist = sums_of(df, sums, by, range_s=range_s, step_s=step_s)
    cumulative = [F.col(f"b_{i}") for i in range(len(edges))]
    return hist.select(
        "eval_ts", *by, bucket_quantile(q, cumulative, F.col("b_inf"), edges).alias("value")
    )


def trailing_share(
    df: DataFrame,
    hit: Column,
    by: list[str],
    *,
    range_s: int,
    step_s: int = MINUTE,
    sums_of: Callable[..., DataFrame] = trailing_sums,
) -> DataFrame:
    """Share of rows with ``hit`` over the trailing range: ``eval_ts, by, value``."""
    sums = {"_hit": F.count_if(hit), "_all": F.count("*")}
    out = sums_of(df, sums, by, range_s=range_s, step_s=step_s)
    return out.select("eval_ts", *by, (F.col("_hit") / F.col("_all")).alias("value"))


def _evaluations(values: DataFrame, alert: str, series: str, active: Column) -> DataFrame:
    return values.select(
        F.lit(alert).alias("alert"),
        F.col(series).alias("series"),
        "eval_ts",
        "value",
        active.alias("active"),
    )


def high_error_rate(
    df: DataFrame, *, error_col: str = "is_error", by: str = "namespace", sums_of=trailing_sums
) -> DataFrame:
    threshold, range_s, _ = ALERTS["high_error_rate"]
    values = trailing_share(df, F.col(error_col), [by], range_s=range_s, sums_of=sums_of)
    return _evaluations(values, "high_error_rate", by, F.col("value") > threshold)


def high_latency(df: DataFrame, *, by: str = "family", sums_of=trailing_sums) -> DataFrame:
    threshold, range_s, _ = ALERTS["high_latency"]
    values = trailing_quantile(
        df, F.col("latency_s"), LATENCY_EDGES, 0.95, by=[by], range_s=range_s, sums_of=sums_of
    )
    return _evaluations(values, "high_latency", by, F.col("value") > threshold)


def confidence_collapse(
    df: DataFrame, *, by: str = "family", sums_of=trailing_sums
) -> DataFrame:
    threshold, range_s, _ = ALERTS["confidence_collapse"]
    values = trailing_quantile(
        df, F.col("confidence"), CONFIDENCE_EDGES, 0.5, by=[by], range_s=range_s, sums_of=sums_of
    )
    return _evaluations(values, "confidence_collapse", by, F.col("value") < threshold)


def class_imbalance(
    df: DataFrame, *, by: str = "family", sums_of=trailing_sums
) -> DataFrame:
    """Evaluations of both imbalance alerts, from one pass."""
    high, range_s, _ = ALERTS["class_imbalance_high"]
    low = ALERTS["class_imbalance_low"][0]
    values = trailing_share(
        df, F.col("label") == POSITIVE, [by], range_s=range_s, sums_of=sums_of
    )
    value = F.col("value")
    both = F.inline(
        F.array(
            F.struct(F.lit("class_imbalance_high").alias("alert"), (value > high).alias("active")),
            F.struct(F.lit("class_imbalance_low").alias("alert"), (value < low).alias("active")),
        )
    )
    return values.select(F.col(by).alias("series"), "eval_ts", "value", both).select(
        "alert", "series", "eval_ts", "value", "active"
    )


def drift_alert(
    gauge: DataFrame, now: Column, *, series: list[str], family_col: str = "family"
) -> DataFrame:
    """Families with drift: the last gauge value of each series in the range, then the maximum.

    ``gauge`` has ``ts, value`` and the columns named in ``series`` and ``family_col``.
    """
    threshold, range_s, _ = ALERTS["drift_detected"]
    since = now - F.make_dt_interval(secs=F.lit(range_s))
    recent = gauge.where((F.col("ts") > since) & (F.col("ts") <= now))
    last = recent.groupBy(family_col, *[s for s in series if s != family_col]).agg(
        F.max_by("value", "ts").alias("value")
    )
    return (
        last.groupBy(F.col(family_col).alias("family"))
        .agg(F.max("value").alias("value"))
        .where(F.col("value") == threshold)
    )


def _hold_of(alert: Column, hold_s: int | dict[str, int]) -> Column:
    if isinstance(hold_s, int):
        return F.lit(hold_s)
    named = [F.lit(x) for pair in hold_s.items() for x in pair]
    return F.create_map(*named)[alert]


def hold(
    evaluations: DataFrame, hold_s: int | dict[str, int], *, step_s: int = MINUTE
) -> DataFrame:
    """Active evaluations with ``pending_since`` and ``firing``; ``hold_s`` for all or by alert.

    An alert fires once it has been active at every step for ``hold_s``; an inactive or missing
    step resets it. A series has one row per step, so its rows are few.
    """
    series = Window.partitionBy("alert", "series")
    step = F.floor(F.unix_seconds("eval_ts") / step_s)
    island = step - F.row_number().over(series.orderBy("eval_ts"))
    run = Window.partitionBy("alert", "series", "_island")
    return (
        evaluations.where("active")
        .withColumn("_island", island)
        .withColumn("pending_since", F.min("eval_ts").over(run))
        .withColumn(
            "firing",
            F.unix_seconds("eval_ts") - F.unix_seconds("pending_since")
            >= _hold_of(F.col("alert"), hold_s),
        )
        .select("alert", "series", "eval_ts", "pending_since", "firing")
    )


# The result's columns, as its readers name them, are champion_label, other_family,
# other_label and count.
def disagreements(
    df: DataFrame, *, request_col: str = "request_id", seq_col: str = "seq"
) -> DataFrame:
    """Answers that differ from their request's majority, counted.

    The majority runs over the families that answered; a tie goes to the label seen first
    (lowest ``seq``). Returns ``champion_label, other_family, other_label, count``.
    """
    # Counted per family and label first: a request of any size is a few rows from here on.
    cells = (
        df.where(F.col("label").isNotNull())
        .groupBy(request_col, "family", "label")
        .agg(F.count("*").alias("n"), F.min(seq_col).alias("first_seq"))
    )
    votes = cells.groupBy(request_col, "label").agg(
        F.sum("n").alias("n"), F.min("first_seq").alias("first_seq")
    )
    majority = votes.groupBy(request_col).agg(
        F.max_by("label", F.struct(F.col("n"), -F.col("first_seq"))).alias("champion_label")
    )
    return (
        cells.join(majority, request_col)
        .where(F.col("label") != F.col("champion_label"))
        .groupBy(
            "champion_label",
            F.col("family").alias("other_family"),
            F.col("label").alias("other_label"),
        )
        .agg(F.sum("n").alias("count"))
    )


def recent_log(
    df: DataFrame, n: int = 50, *, request_col: str = "request_id", error_col: str = "is_error"
) -> DataFrame:
    """The newest ``n`` requests, one row per answer, with failed calls marked.

    ``n`` bounds the request list that is broadcast. A request's time is its latest answer.
    """
    newest = (
        df.groupBy(request_col)
        .agg(F.max("ts").alias("_at"))
        .orderBy(F.desc("_at"), F.desc(request_col))
        .limit(n)
    )
    ok = ~F.coalesce(F.col(error_col), F.lit(False))
    return df.join(F.broadcast(newest), request_col).select(
        request_col,
        F.col("_at").alias("ts"),
        preview("text").alias("text"),
        "family",
        F.when(ok, F.coalesce("label", F.lit("?"))).otherwise("ERR").alias("label"),
        F.when(ok, F.coalesce("confidence", F.lit(0.0))).otherwise(0.0).alias("confidence"),
        F.when(ok, F.coalesce("latency_ms", F.lit(0.0))).otherwise(0.0).alias("latency_ms"),
        F.when(ok, F.coalesce("version", F.lit("?"))).otherwise("?").alias("version"),
    )


def deployed_versions(df: DataFrame) -> DataFrame:
    """Latest ``version`` and ``data_version`` per family."""
    latest = F.max_by(F.struct("version", "data_version"), F.col("ts"))
    return df.groupBy("family").agg(latest.alias("d")).select("family", "d.version", "d.data_version")
