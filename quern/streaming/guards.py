"""Stateful guards over log streams: divergence that fails the query, and silence."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class Diverged(RuntimeError):
    """A run has logged too many non-finite values in a row."""


def advance(streak: int, step: int, value: object, grace: int) -> int:
    """The streak after one observation; steps in grace and values that are no numbers leave it."""
    if step <= grace:
        return streak
    try:
        x = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return streak
    return 0 if math.isfinite(x) else streak + 1


class DivergenceGuard(StatefulProcessor):
    """Per run the streak; rows (run_id, step, streak) of every observation that extends one. With `stop`, a full streak raises."""

    def __init__(self, grace: int = 2, window: int = 3, stop: bool = True) -> None:
        self.grace, self.window, self.stop = grace, window, stop

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.streak = handle.getValueState("streak", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n = self.streak.get()[0] if self.streak.exists() else 0
        out = []
        for row in pd.concat(list(rows)).sort_values("step").itertuples():
            before, n = n, advance(n, row.step, row.grad_norm, self.grace)
            if n > before:
                out.append((key[0], row.step, n))
            if n >= self.window and self.stop:
                raise Diverged(f"run {key[0]}: {n} non-finite values in a row at step {row.step}")
        self.streak.update((n,))
        yield pd.DataFrame(out, columns=["run_id", "step", "streak"])

    def close(self) -> None:
        pass


def guard_divergence(logs: DataFrame, grace: int = 2, window: int = 3, stop: bool = True) -> DataFrame:
    """Stream (run_id, step, grad_norm string) -> streak rows; needs the RocksDB state store."""
    return logs.groupBy("run_id").transformWithStateInPandas(DivergenceGuard(grace, window, stop), "run_id string, step long, streak int", "Append", "none")


class Heartbeat(StatefulProcessor):
    """Per stream name: a row (name, silent_ms) whenever nothing has come for `every` milliseconds, and again after each such span."""

    def __init__(self, every: int = 60_000) -> None:
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", "t long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for _ in rows:
            pass
        now = timerValues.getCurrentProcessingTimeInMs()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.last.update((now,))
        self.handle.registerTimer(now + self.every)
        yield pd.DataFrame({"name": [], "silent_ms": []}).astype({"name": "str", "silent_ms": "int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.every)
        yield pd.DataFrame({"name": [key[0]], "silent_ms": [now - self.last.get()[0]]})

    def close(self) -> None:
        pass


def heartbeats(lines: DataFrame, every: int = 60_000) -> DataFrame:
    """Stream with a column name -> heartbeat rows on silence."""
    return lines.groupBy("name").transformWithStateInPandas(Heartbeat(every), "name string, silent_ms long", "Append", "ProcessingTime")
