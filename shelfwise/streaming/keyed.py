"""Keyed state machines on event time: buffered flushes, message expiry, task lifecycles.

Each walks the rows of its key in order from the state that the last call left, so results do not depend on how the
stream is cut into batches, as long as rows of a key arrive in order.  State lives in the checkpoint: what a failed
batch had done is done again from there.

Flushes and lifecycles have very many keys with few rows each, and every call into the state costs more than walking
them: keys are dealt into ``BUCKETS`` buckets by hash, and a bucket's keys share one state row and one timer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

FLUSH_ROWS, FLUSH_SECONDS = 50, 30
TTL_SECONDS = 60
TIMEOUT_SECONDS, MAX_RETRIES = 300, 3
BUCKETS = 4096


def _in_order(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(by, kind="stable")


def _texts(column: pd.Series) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in column]


def _times(column: pd.Series) -> list[int | None]:
    return column.tolist() if column.dtype.kind == "i" else [None if pd.isna(x) else int(x) for x in column]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _set_timer(handle, due: list[int]) -> None:
    """The bucket's only timer, at the first of the times that its keys wait for."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    if due:
        handle.registerTimer(min(due))


def _passed(timerValues, expiredTimerInfo) -> int:
    """The last millisecond whose timers are due: the one told, and all before the watermark."""
    return max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)


class FlushBuffer(StatefulProcessor):
    """Holds the rows of each source back until there are ``limit`` of them or the first one has waited ``wait_ms``."""

    def __init__(self, limit: int, wait_ms: int):
        self.limit, self.wait_ms = limit, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        fields = "source array<string>, flush array<bigint>, item array<array<string>>, ts_ms array<array<bigint>>"
        self.state = handle.getValueState("held", fields)

    def _held(self) -> dict[str | None, tuple[int, list, list]]:
        """Number of the next flush, held items and their times per source."""
        if not self.state.exists():
            return {}
        sources, *rest = self.state.get()
        return {s: (n, list(items), list(times)) for s, n, items, times in zip(sources, *rest)}

    def _keep(self, held: dict[str | None, tuple[int, list, list]]) -> None:
        numbers, items, times = ([h[i] for h in held.values()] for i in range(3))
        self.state.update((list(held), numbers, items, times))
        _set_timer(self.handle, [t[0] + self.wait_ms for t in times if t and t[0] is not None])

    def _frames(self, flushes: list[tuple]) -> Iterator[pd.DataFrame]:
        if flushes:
            rows = [(s, n, reason, at, i, t) for s, n, reason, at, items, times in flushes for i, t in zip(items, times)]
            yield pd.DataFrame(rows, columns=["source", "flush", "reason", "at_ms", "item", "ts_ms"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, out = self._held(), []
        new = _in_order(rows, ["ts_ms", "item"])
        for source, item, ts in zip(_texts(new["source"]), _texts(new["item"]), _times(new["ts_ms"])):
            number, items, times = held.get(source) or (0, [], [])
            if items and ts is not None and times[0] is not None and ts - times[0] >= self.wait_ms:
                out.append((source, number, "time", times[0] + self.wait_ms, items, times))
                number, items, times = number + 1, [], []
            items.append(item)
            times.append(ts)
            if len(items) == self.limit:
                out.append((source, number, "count", ts, items, times))
                number, items, times = number + 1, [], []
            held[source] = (number, items, times)
        self._keep(held)
        yield from self._frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, out, now = self._held(), [], _passed(timerValues, expiredTimerInfo)
        for source, (number, items, times) in held.items():
            if items and times[0] is not None and times[0] + self.wait_ms <= now:
                out.append((source, number, "time", times[0] + self.wait_ms, items, times))
                held[source] = (number + 1, [], [])
        self._keep(held)
        yield from self._frames(out)

    def close(self) -> None:
        pass


def buffered(
    stream: DataFrame, source: str, ts: str, item: str, limit: int = FLUSH_ROWS, wait_seconds: int = FLUSH_SECONDS, late: str = "0 seconds"
) -> DataFrame:
    """Rows in flushes: (source, flush, reason, at_ms, item, ts_ms).

    A flush holds ``limit`` rows of a source, or what came within ``wait_seconds`` of its first row; the time-out is
    told when the watermark passes it or a later row arrives.  ``item`` carries the record as text.  At most ``limit``
    rows of a source are held.
    """
    rows = stream.withWatermark(ts, late).select(
        F.col(source).cast("string").alias("source"), F.col(ts), F.col(item).cast("string").alias("item"), F.unix_millis(ts).alias("ts_ms")
    )
    return rows.withColumn("bucket", _bucket("source")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=FlushBuffer(limit, wait_seconds * 1000),
        outputStructType="source string, flush bigint, reason string, at_ms bigint, item string, ts_ms bigint",
        outputMode="Append",
        timeMode="EventTime",
    )


class Expiry(StatefulProcessor):
    """Marks messages that are older than the newest one before them by more than ``ttl_ms``."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.newest = handle.getValueState("newest", "ts_ms bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = _in_order(rows, ["arrival"])
        known = self.newest.get()[0] if self.newest.exists() else np.iinfo(np.int64).min // 2
        own = new["ts_ms"].to_numpy()
        newest = np.maximum.accumulate(np.concatenate([[known], own]))
        self.newest.update((int(newest[-1]),))
        yield pd.DataFrame({"target": key[0], "message": new["message"], "ts_ms": own, "expired": own < newest[:-1] - self.ttl_ms})

    def close(self) -> None:
        pass


def split_expired(stream: DataFrame, target: str, ts: str, message: str, arrival: str, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """(target, message, ts_ms, expired) for every message, none dropped.

    A message has expired if, by the time it arrives, a message to the same target that is newer by more than
    ``ttl_seconds`` has arrived.  ``arrival`` numbers the messages as they come.
    """
    rows = stream.select(
        F.col(target).cast("string").alias("target"), F.col(message).cast("string").alias("message"),
        F.unix_millis(ts).alias("ts_ms"), F.col(arrival).cast("long").alias("arrival"),
    )
    return rows.groupBy("target").transformWithStateInPandas(
        statefulProcessor=Expiry(ttl_seconds * 1000),
        outputStructType="target string, message string, ts_ms bigint, expired boolean",
        outputMode="Append",
        timeMode="None",
    )


class Lifecycle(StatefulProcessor):
    """Runs the tasks' attempts: started, then completed, failed or timed out; so many retries, then failed for good."""

    def __init__(self, timeout_ms: int, retries: int):
        self.timeout_ms, self.retries = timeout_ms, retries

    def init(self, handle) -> None:
        self.handle = handle
        # the last attempt of every task, when it started if it is open, and whether the task is over
        self.state = handle.getValueState("tasks", "task array<string>, attempt array<int>, started_ms array<bigint>, over array<boolean>")

    def _tasks(self) -> dict[str | None, tuple[int, int | None, bool]]:
        if not self.state.exists():
            return {}
        tasks, *rest = self.state.get()
        return dict(zip(tasks, zip(*rest)))

    def _keep(self, tasks: dict[str | None, tuple[int, int | None, bool]]) -> None:
        attempts, started, over = ([t[i] for t in tasks.values()] for i in range(3))
        self.state.update((list(tasks), attempts, started, over))
        _set_timer(self.handle, [s + self.timeout_ms for s in started if s is not None])

    def _ended(self, task: str | None, attempt: int, at: int | None, how: str, out: list[tuple]) -> bool:
        over = how == "completed" or attempt > self.retries
        out.append((task, attempt, at, how))
        if how != "completed":
            out.append((task, attempt, at, "given up" if over else "retrying"))
        return over

    def _frames(self, out: list[tuple]) -> Iterator[pd.DataFrame]:
        if out:
            yield pd.DataFrame(out, columns=["task", "attempt", "at_ms", "state"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tasks, out = self._tasks(), []
        new = _in_order(rows, ["ts_ms", "arrival"])
        for task, ts, event in zip(_texts(new["task"]), _times(new["ts_ms"]), new["event"].tolist()):
            attempt, started, over = tasks.get(task, (0, None, False))
            if started is not None and ts is not None and ts >= started + self.timeout_ms:
                over = self._ended(task, attempt, started + self.timeout_ms, "timeout", out)
                started = None
            if not over:
                if event == "started" and started is None:
                    attempt, started = attempt + 1, ts
                    out.append((task, attempt, ts, "running"))
                elif event in ("completed", "failed") and started is not None:
                    over = self._ended(task, attempt, ts, event, out)
                    started = None
            tasks[task] = (attempt, started, over)
        self._keep(tasks)
        yield from self._frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tasks, out, now = self._tasks(), [], _passed(timerValues, expiredTimerInfo)
        for task, (attempt, started, _) in tasks.items():
            if started is not None and started + self.timeout_ms <= now:
                over = self._ended(task, attempt, started + self.timeout_ms, "timeout", out)
                tasks[task] = (attempt, None, over)
        self._keep(tasks)
        yield from self._frames(out)

    def close(self) -> None:
        pass


def lifecycle(
    stream: DataFrame, task: str, ts: str, event: Column, arrival: str,
    timeout_seconds: int = TIMEOUT_SECONDS, retries: int = MAX_RETRIES, late: str = "0 seconds",
) -> DataFrame:
    """Transitions of every task: (task, attempt, at_ms, state).

    ``event`` is ``started``, ``completed`` or ``failed``; others are signs of life without effect.  States: running,
    completed, failed, timeout, and after the last two retrying, or given up once there were ``retries`` retries.
    What comes after completed or given up is ignored.  An open attempt times out when a later row of the task or the
    watermark passes its limit.
    """
    rows = stream.withWatermark(ts, late).select(
        F.col(task).cast("string").alias("task"), F.col(ts), F.unix_millis(ts).alias("ts_ms"), event.alias("event"),
        F.col(arrival).cast("long").alias("arrival"),
    )
    return rows.withColumn("bucket", _bucket("task")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Lifecycle(timeout_seconds * 1000, retries),
        outputStructType="task string, attempt int, at_ms bigint, state string",
        outputMode="Append",
        timeMode="EventTime",
    )
