"""From predictions to firing alerts: tiles, trailing windows and hold times as one plan.

On a stream the three are a chain of stateful operators in append mode: tiles close with the
watermark, windows over them with the tiles, and every closed evaluation goes to the hold time of
its series. Behind the watermark the result equals the batch form's.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textward.operators import monitor
from textward.streaming.holds import stream_hold_marked
from textward.streaming.predictions import stream_trailing_sums
from textward.streaming.sinks import start_fanout

HOLDS = {alert: hold_s for alert, (_, _, hold_s) in monitor.ALERTS.items()}

_EVALUATED = (
    monitor.high_error_rate,
    monitor.high_latency,
    monitor.confidence_collapse,
    monitor.class_imbalance,
)


def evaluations(
    predictions: DataFrame, *, sums_of: Callable[..., DataFrame] = monitor.trailing_sums
) -> DataFrame:
    """Evaluations of all alerts over trailing windows, active or not."""
    return functools.reduce(
        DataFrame.unionByName, [alert(predictions, sums_of=sums_of) for alert in _EVALUATED]
    )


def alert_holds(predictions: DataFrame) -> DataFrame:
    """Active evaluations of a table of predictions, with their hold times."""
    return monitor.hold(evaluations(predictions), HOLDS)


def stream_alert_holds(predictions: DataFrame) -> DataFrame:
    """Streaming form of ``alert_holds``, with late evaluations marked ``late``.

    The stream has to be of a ``holds.stateful_session``. A series that reports no more loses its
    state once the watermark has passed.
    """
    found = evaluations(predictions, sums_of=stream_trailing_sums)
    return stream_hold_marked(found, HOLDS, expire=True)


def start_alerts(
    predictions: DataFrame, base: str, checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Run the chain into the tables ``<base>/held`` and ``<base>/late``."""
    late = F.col("late")
    return start_fanout(
        stream_alert_holds(predictions),
        base,
        checkpoint,
        {
            "held": lambda rows: rows.where(~late).drop("late"),
            "late": lambda rows: rows.where(late).select("alert", "series", "eval_ts"),
        },
        available_now=available_now,
    )
