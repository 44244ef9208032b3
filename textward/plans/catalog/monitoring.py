"""Counters, histograms, rates, quantiles and alerts over predictions, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.operators import monitor
from textward.operators.monitor import HOUR, MINUTE
from textward.plans import alerting
from textward.plans.catalog.sources import _logged
from textward.plans.catalog.tables import (
    PREDICTIONS,
    as_predictions,
    predictions,
    sql_sample_key,
    stream_of,
    table,
)
from textward.sources.store import materialize, scratch_path
from textward.streaming.holds import stateful_session, stream_hold
from textward.streaming.predictions import (
    start_table_sink,
    stream_counts,
    stream_histograms,
    stream_trailing_sums,
)
from textward.streaming.sinks import read_part


def _seconds(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as epoch seconds, so results do not depend on a session time zone."""
    return df.withColumns({n: F.unix_seconds(n) for n in names})


def _finish(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    start_table_sink(stream, f"{base}/rows", f"{base}/state", available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def _stream(spark: SparkSession, sf: str) -> DataFrame:
    return as_predictions(stream_of(spark, sf, "events"))


def counts(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(monitor.prediction_counts(predictions(spark, sf)), "window_start")


def counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(_finish(spark, stream_counts(_stream(spark, sf)), "counts"), "window_start")


def _readable(hist: DataFrame) -> DataFrame:
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return _seconds(hist, "window_start").withColumns({"le": le, "sum": F.round("sum", 6)})


def histograms(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(monitor.prediction_histograms(predictions(spark, sf), "1 day"))


def histograms_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _readable(_finish(spark, stream_histograms(_stream(spark, sf), width="1 day"), "histograms"))


def rates_5m(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(monitor.rates(predictions(spark, sf), ["family", "label"]), "eval_ts")


def rates_1h(spark: SparkSession, sf: str) -> DataFrame:
    out = monitor.rates(predictions(spark, sf), ["family"], range_s=HOUR, step_s=5 * MINUTE)
    return _seconds(out, "eval_ts")


def rates_stream(spark: SparkSession, sf: str) -> DataFrame:
    rates = monitor.rates(
        _stream(spark, sf),
        ["family"],
        range_s=HOUR,
        step_s=5 * MINUTE,
        sums_of=stream_trailing_sums,
    )
    return _seconds(_finish(spark, rates, "rates"), "eval_ts")


def quantiles(spark: SparkSession, sf: str) -> DataFrame:
    out = monitor.trailing_quantile(
        predictions(spark, sf),
        F.col("confidence"),
        monitor.CONFIDENCE_EDGES,
        0.95,
        by=["family"],
        range_s=HOUR,
        step_s=5 * MINUTE,
    )
    return _rounded(out)


def _rounded(values: DataFrame) -> DataFrame:
    return _seconds(values, "eval_ts").withColumn("value", F.round("value", 9))


def _active(evaluations: DataFrame) -> DataFrame:
    return _rounded(evaluations.where("active")).drop("active")


def error_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _active(monitor.high_error_rate(predictions(spark, sf)))


def latency(spark: SparkSession, sf: str) -> DataFrame:
    return _active(monitor.high_latency(predictions(spark, sf)))


def collapse(spark: SparkSession, sf: str) -> DataFrame:
    return _active(monitor.confidence_collapse(predictions(spark, sf)))


def imbalance(spark: SparkSession, sf: str) -> DataFrame:
    return _active(monitor.class_imbalance(predictions(spark, sf)))


def _alert_stream(evaluate):
    """Streaming form of an alert's query."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        evaluations = evaluate(_stream(spark, sf), sums_of=stream_trailing_sums)
        return _active(_finish(spark, evaluations, "alert"))

    return query


def _gauge(spark: SparkSession, sf: str) -> DataFrame:
    """Every user is a gauge series of its family; its value is 1 in a third of the samples."""
    return predictions(spark, sf).select(
        "ts",
        "family",
        (F.col("event_id") % 50).alias("job"),
        (F.col("event_id") % 3 == F.substring("family", 4, 1).cast("int")).cast("double").alias("value"),
    )


def drift(spark: SparkSession, sf: str) -> DataFrame:
    gauge = _gauge(spark, sf)
    now = F.lit(gauge.agg(F.max("ts")).scalar())
    return monitor.drift_alert(gauge, now, series=["job"])


def held(spark: SparkSession, sf: str) -> DataFrame:
    out = monitor.hold(monitor.class_imbalance(predictions(spark, sf)), HOUR)
    return _seconds(out, "eval_ts", "pending_since")


def held_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The evaluations arrive in three parts, in time order.

    Each part is a run of its own that goes on from the checkpoint of the one before.
    """
    evaluations = materialize(monitor.class_imbalance(predictions(spark, sf)), "evaluations")
    base = scratch_path(spark, "evaluations-in")
    at = F.unix_seconds("eval_ts")
    first, last = evaluations.agg(F.min(at), F.max(at)).first()
    cuts = [first, first + (last - first) // 3, first + 2 * (last - first) // 3, last + 1]
    session = stateful_session(spark)
    out = scratch_path(spark, "held")
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        evaluations.where((at >= lo) & (at < hi)).write.mode("append").parquet(base)
        stream = stream_hold(session.readStream.schema(evaluations.schema).parquet(base), HOUR)
        start_table_sink(stream, f"{out}/rows", f"{out}/state", available_now=True).awaitTermination()
    held_rows = spark.read.schema(stream.schema).parquet(f"{out}/rows")
    return _seconds(held_rows, "eval_ts", "pending_since")


def alert_holds(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(alerting.alert_holds(predictions(spark, sf)), "eval_ts", "pending_since")


def alert_holds_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events to firing alerts in one streaming query."""
    stream = as_predictions(stream_of(spark, sf, "events", stateful_session(spark)))
    base = scratch_path(spark, "alerts")
    alerting.start_alerts(stream, base, f"{base}/state", available_now=True).awaitTermination()
    schema = alerting.stream_alert_holds(stream).drop("late").schema
    return _seconds(read_part(spark, base, "held", schema), "eval_ts", "pending_since")


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Three events make a request, each answered by another family; failed calls have no label."""
    rows = predictions(spark, sf)
    ok = ~F.col("is_error")
    return rows.select(
        "request_id",
        "event_id",
        "ts",
        F.concat(F.lit("fam"), (F.col("event_id") % 3).cast("string")).alias("family"),
        F.when(ok, F.col("label")).alias("label"),
        F.when(ok, F.col("confidence")).alias("confidence"),
        F.when(ok, F.col("value")).alias("latency_ms"),
        F.when(ok, F.concat(F.lit("v"), (F.col("event_id") % 7).cast("string"))).alias("version"),
        F.concat(F.lit("d"), (F.col("event_id") % 5).cast("string")).alias("data_version"),
        "is_error",
        "text",
    )


def disagreements(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.disagreements(_answers(spark, sf), seq_col="event_id")


def recent(spark: SparkSession, sf: str) -> DataFrame:
    return _seconds(monitor.recent_log(_answers(spark, sf)), "ts")


def deployed(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.deployed_versions(_answers(spark, sf).where(F.col("version").isNotNull()))


def sampled_log(spark: SparkSession, sf: str) -> DataFrame:
    return _logged(spark, sf, 0.1)


QUERIES = {
    "k01_prediction_counts": counts,
    "k01_prediction_counts_stream": counts_stream,
    "k02_histograms": histograms,
    "k02_histograms_stream": histograms_stream,
    "k03_rate_5m": rates_5m,
    "k03_rate_1h": rates_1h,
    "k03_rate_1h_stream": rates_stream,
    "k04_bucket_quantile": quantiles,
    "k05_high_error_rate": error_rate,
    "k05_high_error_rate_stream": _alert_stream(monitor.high_error_rate),
    "k06_high_latency": latency,
    "k06_high_latency_stream": _alert_stream(monitor.high_latency),
    "k07_confidence_collapse": collapse,
    "k07_confidence_collapse_stream": _alert_stream(monitor.confidence_collapse),
    "k08_class_imbalance": imbalance,
    "k08_class_imbalance_stream": _alert_stream(monitor.class_imbalance),
    "k09_drift_alert": drift,
    "k10_hold_time": held,
    "k10_hold_time_stream": held_stream,
    "k10_alert_holds": alert_holds,
    "k10_alert_holds_stream": alert_holds_stream,
    "k11_family_disagreement": disagreements,
    "k12_recent_log": recent,
    "k13_deployed_versions": deployed,
    "k14_sampled_log_stream": sampled_log,
}


def _sql_trailing(range_s: int, step_s: int) -> str:
    """Relation of predictions repeated for every evaluation they count for, as ``eval_s``."""
    tile = f"(floor(epoch(ts) / {step_s})::BIGINT + 1) * {step_s}"
    return f"""trailing_rows AS (
  SELECT unnest(range({tile}, {tile} + {range_s}, {step_s})) AS eval_s, * FROM predictions
)"""


def _sql_quantile(value: str, edges: tuple[float, ...], q: float) -> str:
    """CTEs that end in ``quantile(eval_s, family, value)``, from buckets in long form."""
    values = ", ".join(f"({i}, {e}::DOUBLE)" for i, e in enumerate(edges))
    return f"""edges(i, le) AS (VALUES {values}),
totals AS (SELECT eval_s, family, count(*) AS total FROM trailing_rows GROUP BY ALL),
buckets AS (
  SELECT eval_s, family, i, le, count(*) FILTER ({value} <= le) AS cum
  FROM trailing_rows, edges GROUP BY ALL
),
steps AS (
  SELECT *, lag(cum, 1, 0) OVER w AS below, lag(le, 1, 0.0::DOUBLE) OVER w AS low
  FROM buckets WINDOW w AS (PARTITION BY eval_s, family ORDER BY i)
),
hit AS (
  SELECT s.*, total FROM steps s JOIN totals USING (eval_s, family) WHERE cum >= {q} * total
  QUALIFY row_number() OVER (PARTITION BY eval_s, family ORDER BY i) = 1
),
quantile AS (
  SELECT t.eval_s, t.family,
         coalesce(low + (le - low) * (({q}::DOUBLE * t.total - below) / (cum - below)), {edges[-1]}::DOUBLE) AS value
  FROM totals t LEFT JOIN hit USING (eval_s, family)
)"""


def _sql_histograms(closed: str) -> str:
    script = "coalesce((length(text) - length(regexp_replace(text, '[\\x{400}-\\x{4ff}]+', '', 'g'))) / nullif(length(text), 0), 0)"
    metrics = {
        "confidence": (monitor.CONFIDENCE_EDGES, "confidence"),
        "latency_s": (monitor.LATENCY_EDGES, "latency_s"),
        "tokens": (monitor.TOKEN_EDGES, "length(text) / 4.0::DOUBLE"),
        "script_ratio": (monitor.SCRIPT_EDGES, script),
    }
    edges = ", ".join(
        f"('{m}', '{le}', {le}::DOUBLE)" for m, (es, _) in metrics.items() for le in es
    ) + ", " + ", ".join(f"('{m}', '+Inf', 'inf'::DOUBLE)" for m in metrics)
    observed = " UNION ALL ".join(
        f"SELECT floor(epoch(ts) / 86400)::BIGINT * 86400 AS window_start, family, '{m}' AS metric, {v} AS x FROM predictions"
        for m, (_, v) in metrics.items()
    )
    return f"""
WITH {PREDICTIONS}, edges(metric, le, edge) AS (VALUES {edges}), observed AS ({observed})
SELECT window_start, family, metric, le, count(*) FILTER (x <= edge) AS bucket,
       round(sum(x), 6) AS sum, count(*) AS count
FROM observed JOIN edges USING (metric) {closed} GROUP BY ALL"""


_CLOSED = "(SELECT epoch(max(ts)) - 600 FROM predictions)"
_IMBALANCE = f"""{_sql_trailing(HOUR, MINUTE)},
shares AS (
  SELECT eval_s, family AS series, count(*) FILTER (label = 'jailbreak') / count(*) AS value
  FROM trailing_rows GROUP BY ALL
),
imbalance AS (
  SELECT 'class_imbalance_high' AS alert, series, eval_s AS eval_ts, value FROM shares WHERE value > 0.8
  UNION ALL
  SELECT 'class_imbalance_low', series, eval_s, value FROM shares WHERE value < 0.05
)"""

_COUNTS = f"""
WITH {PREDICTIONS}
SELECT floor(epoch(ts) / 3600)::BIGINT * 3600 AS window_start, family, label, count(*) AS count
FROM predictions {{0}} GROUP BY ALL"""

_HOLD = f"""
WITH {PREDICTIONS}, {_IMBALANCE},
marked AS (
  SELECT *, coalesce(eval_ts - lag(eval_ts) OVER w <> 60, true) AS starts
  FROM imbalance WINDOW w AS (PARTITION BY alert, series ORDER BY eval_ts)
),
runs AS (
  SELECT *, max(CASE WHEN starts THEN eval_ts END) OVER (
    PARTITION BY alert, series ORDER BY eval_ts ROWS UNBOUNDED PRECEDING) AS pending_since
  FROM marked
)
SELECT alert, series, eval_ts, pending_since, eval_ts - pending_since >= 3600 AS firing FROM runs"""

_RATE_1H = f"""
WITH {PREDICTIONS}, {_sql_trailing(HOUR, 5 * MINUTE)}
SELECT eval_s AS eval_ts, family, count(*) / 3600.0::DOUBLE AS rate FROM trailing_rows {{0}} GROUP BY ALL"""

_ANSWERS = f"""{PREDICTIONS},
answers AS (
  SELECT request_id, event_id, ts, 'fam' || (event_id % 3)::VARCHAR AS family, is_error, text,
         CASE WHEN NOT is_error THEN label END AS label, confidence, value AS latency_ms,
         'v' || (event_id % 7)::VARCHAR AS version, 'd' || (event_id % 5)::VARCHAR AS data_version
  FROM predictions
)"""

ORACLES = {
    "k01_prediction_counts": _COUNTS.format(""),
    "k01_prediction_counts_stream": _COUNTS.format(
        f"WHERE floor(epoch(ts) / 3600) * 3600 + 3600 <= {_CLOSED}"
    ),
    "k02_histograms": _sql_histograms(""),
    "k02_histograms_stream": _sql_histograms(f"WHERE window_start + 86400 <= {_CLOSED}"),
    "k03_rate_5m": f"""
WITH {PREDICTIONS}, {_sql_trailing(5 * MINUTE, MINUTE)}
SELECT eval_s AS eval_ts, family, label, count(*) / 300.0::DOUBLE AS rate
FROM trailing_rows GROUP BY ALL""",
    "k03_rate_1h": _RATE_1H.format(""),
    "k03_rate_1h_stream": _RATE_1H.format(f"WHERE eval_s <= {_CLOSED}"),
    "k04_bucket_quantile": f"""
WITH {PREDICTIONS}, {_sql_trailing(HOUR, 5 * MINUTE)},
{_sql_quantile('confidence', monitor.CONFIDENCE_EDGES, 0.95)}
SELECT eval_s AS eval_ts, family, round(value, 9) AS value FROM quantile""",
    "k05_high_error_rate": f"""
WITH {PREDICTIONS}, {_sql_trailing(5 * MINUTE, MINUTE)}
SELECT 'high_error_rate' AS alert, namespace AS series, eval_s AS eval_ts,
       round(count(*) FILTER (is_error) / count(*), 9) AS value
FROM trailing_rows GROUP BY ALL HAVING count(*) FILTER (is_error) / count(*) > 0.05""",
    "k06_high_latency": f"""
WITH {PREDICTIONS}, {_sql_trailing(5 * MINUTE, MINUTE)},
{_sql_quantile('latency_s', monitor.LATENCY_EDGES, 0.95)}
SELECT 'high_latency' AS alert, family AS series, eval_s AS eval_ts, round(value, 9) AS value
FROM quantile WHERE value > 0.5""",
    "k07_confidence_collapse": f"""
WITH {PREDICTIONS}, {_sql_trailing(HOUR, MINUTE)},
{_sql_quantile('confidence', monitor.CONFIDENCE_EDGES, 0.5)}
SELECT 'confidence_collapse' AS alert, family AS series, eval_s AS eval_ts, round(value, 9) AS value
FROM quantile WHERE value < 0.6""",
    "k08_class_imbalance": f"""
WITH {PREDICTIONS}, {_IMBALANCE}
SELECT alert, series, eval_ts, round(value, 9) AS value FROM imbalance""",
    "k09_drift_alert": f"""
WITH {PREDICTIONS},
last AS (
  SELECT family, event_id % 50 AS job,
         arg_max((event_id % 3 = substr(family, 4)::INT)::INT::DOUBLE, ts) AS value
  FROM predictions WHERE ts > (SELECT max(ts) FROM predictions) - INTERVAL 8 DAY GROUP BY ALL
)
SELECT family, max(value) AS value FROM last GROUP BY family HAVING max(value) = 1""",
    "k10_hold_time": _HOLD,
    "k10_hold_time_stream": _HOLD,
    "k11_family_disagreement": f"""
WITH {_ANSWERS},
votes AS (
  SELECT request_id, label, count(*) AS n, min(event_id) AS first_seq
  FROM answers WHERE label IS NOT NULL GROUP BY ALL
),
majority AS (
  SELECT request_id, label AS champion_label FROM votes
  QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY n DESC, first_seq) = 1
)
SELECT champion_label, family AS other_family, label AS other_label, count(*) AS count
FROM answers JOIN majority USING (request_id) WHERE label <> champion_label GROUP BY ALL""",
    "k12_recent_log": f"""
WITH {_ANSWERS},
newest AS (
  SELECT request_id, max(ts) AS newest_ts FROM answers GROUP BY request_id ORDER BY newest_ts DESC, request_id DESC LIMIT 50
)
SELECT request_id, floor(epoch(newest_ts))::BIGINT AS ts,
       substr(text, 1, 80) || CASE WHEN length(text) > 80 THEN '...' ELSE '' END AS text, family,
       CASE WHEN is_error THEN 'ERR' ELSE label END AS label,
       CASE WHEN is_error THEN 0 ELSE confidence END AS confidence,
       CASE WHEN is_error THEN 0 ELSE latency_ms END AS latency_ms,
       CASE WHEN is_error THEN '?' ELSE version END AS version
FROM answers JOIN newest USING (request_id)""",
    "k13_deployed_versions": f"""
WITH {_ANSWERS}
SELECT family, arg_max(version, ts) AS version, arg_max(data_version, ts) AS data_version
FROM answers WHERE NOT is_error GROUP BY family""",
    "k14_sampled_log_stream": f"""
WITH {PREDICTIONS}
SELECT event_id, label, ts::DATE::VARCHAR AS date, family FROM predictions
WHERE ('0x' || substr({sql_sample_key('event_id')}, 1, 8))::BIGINT < {0.1 * 2**32}::DOUBLE""",
}

# A stream has emitted the evaluations its watermark has passed.
ORACLES |= {
    f"{name}_stream": f"""
WITH batch AS ({ORACLES[name]})
SELECT * FROM batch WHERE eval_ts <= (SELECT epoch(max(ts)) - 600 FROM events)"""
    for name in (
        "k05_high_error_rate",
        "k06_high_latency",
        "k07_confidence_collapse",
        "k08_class_imbalance",
    )
}

_HOLDS = ", ".join(f"('{alert}', {hold_s})" for alert, hold_s in alerting.HOLDS.items())
_ACTIVE = " UNION ALL ".join(
    f"SELECT alert, series, eval_ts FROM ({ORACLES[name]})"
    for name in (
        "k05_high_error_rate",
        "k06_high_latency",
        "k07_confidence_collapse",
        "k08_class_imbalance",
    )
)
ORACLES["k10_alert_holds"] = f"""
WITH active AS ({_ACTIVE}), holds(alert, hold_s) AS (VALUES {_HOLDS}),
marked AS (
  SELECT *, coalesce(eval_ts - lag(eval_ts) OVER w <> 60, true) AS starts
  FROM active WINDOW w AS (PARTITION BY alert, series ORDER BY eval_ts)
),
runs AS (
  SELECT *, max(CASE WHEN starts THEN eval_ts END) OVER (
    PARTITION BY alert, series ORDER BY eval_ts ROWS UNBOUNDED PRECEDING) AS pending_since
  FROM marked
)
SELECT alert, series, eval_ts, pending_since, eval_ts - pending_since >= hold_s AS firing
FROM runs JOIN holds USING (alert)"""
ORACLES["k10_alert_holds_stream"] = f"""
WITH batch AS ({ORACLES['k10_alert_holds']})
SELECT * FROM batch WHERE eval_ts <= (SELECT epoch(max(ts)) - 600 FROM events)"""
