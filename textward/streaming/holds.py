"""Alert hold times on a stream of evaluations, by ``transformWithState``.

A series' state is one typed value: its last step and the start of its active run. Steps of a
micro-batch are handled as arrays. Evaluations that come at or before the last step are a second
output: they change nothing and are reported instead of lost. On streams with a watermark, a timer
drops the state of a series that has stopped reporting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textward.operators.monitor import MINUTE

_OUTPUT = (
    "alert string, series string, eval_s bigint, pending_s bigint, firing boolean, late boolean"
)
_STATE = "last_s bigint, pending_s bigint"
_NEVER = -(2**62)
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session for streams with typed state: RocksDB keeps it, a partition per core.

    State has as many partitions as its session shuffles into; on a cluster that is the number of
    cores at the start, which stays fixed for the life of the checkpoint.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    session.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    return session


def run_starts(
    at: np.ndarray, active: np.ndarray, last: int, pending: int, step_s: int
) -> np.ndarray:
    """For each of the ascending steps the start of its active run, or ``_NEVER``.

    ``last`` and ``pending`` are the step before and its run's start.
    """
    before = np.r_[last, at[:-1]]
    running = np.r_[pending != _NEVER, active[:-1]]
    starts = active & (~running | (at - before != step_s))
    # Steps ascend, so the latest start so far is the greatest.
    latest = np.maximum.accumulate(np.r_[pending, np.where(starts, at, _NEVER)])[1:]
    return np.where(active, latest, _NEVER)


class HoldTimes(StatefulProcessor):
    """Holds of one series; ``hold_s`` in seconds, for all alerts or by the alert's name."""

    def __init__(self, hold_s: int | dict[str, int], step_s: int, expire: bool):
        self.hold_s, self.step_s, self.expire = hold_s, step_s, expire

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _STATE)

    def _timer(self, last: int) -> int:
        """When a series counts as ended: two steps without an evaluation."""
        return (last + 2 * self.step_s) * 1000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        alert, series = key
        steps = pd.concat(list(rows)).sort_values("eval_s")
        every = steps["eval_s"].to_numpy(np.int64)
        last, pending = self.run.get() if self.run.exists() else (_NEVER, _NEVER)
        late = (every <= last) | np.r_[False, every[1:] == every[:-1]]
        at, active = every[~late], steps["active"].to_numpy(bool)[~late]
        if len(at):
            since = run_starts(at, active, last, pending, self.step_s)
            if self.expire:
                if last != _NEVER:
                    self.handle.deleteTimer(self._timer(last))
                self.handle.registerTimer(self._timer(int(at[-1])))
            self.run.update((int(at[-1]), int(since[-1])))
            hold_s = self.hold_s if isinstance(self.hold_s, int) else self.hold_s[alert]
            since, at = since[active], at[active]
            yield self._rows(alert, series, at, since, at - since >= hold_s, False)
        if late.any():
            yield self._rows(alert, series, every[late], None, None, True)

    @staticmethod
    def _rows(alert, series, at, since, firing, late) -> pd.DataFrame:
        out = pd.DataFrame({"eval_s": at, "pending_s": since, "firing": firing, "late": late})
        out.insert(0, "alert", alert)
        out.insert(1, "series", series)
        return out.astype({"pending_s": "Int64", "firing": "boolean"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_hold_marked(
    evaluations: DataFrame,
    hold_s: int | dict[str, int],
    *,
    step_s: int = MINUTE,
    expire: bool = False,
) -> DataFrame:
    """``monitor.hold`` on a stream, with late evaluations as rows marked ``late``.

    Evaluations have to arrive in time order across micro-batches, as a windowed aggregate emits
    them; those at or before the last seen step are late. ``expire`` drops the state of series that
    have ended, on streams with a watermark. The stream's session has to be a ``stateful_session``.
    """
    held = (
        evaluations.select("alert", "series", F.unix_seconds("eval_ts").alias("eval_s"), "active")
        .groupBy("alert", "series")
        .transformWithStateInPandas(
            HoldTimes(hold_s, step_s, expire),
            _OUTPUT,
            "append",
            "eventTime" if expire else "none",
        )
    )
    return held.select(
        "alert",
        "series",
        F.timestamp_seconds("eval_s").alias("eval_ts"),
        F.timestamp_seconds("pending_s").alias("pending_since"),
        "firing",
        "late",
    )


def stream_hold(
    evaluations: DataFrame, hold_s: int | dict[str, int], *, step_s: int = MINUTE
) -> DataFrame:
    """Streaming form of ``monitor.hold``; late evaluations are left out."""
    return stream_hold_marked(evaluations, hold_s, step_s=step_s).where(~F.col("late")).drop("late")
