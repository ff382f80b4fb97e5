"""Alarms after silence: state and timers per key of our own."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallymill.streaming.jobs import Transform, zone_less

_PENDING = "low array<bigint>, high array<bigint>, n array<bigint>"
_RESULT = "user_id long, last long, n_events long, alarm_no long"


def _rows(done: list[tuple]) -> pd.DataFrame:
    """Alarms as rows; the user may be null, who is a user like any other."""
    return pd.DataFrame(done, columns=["user_id", "last", "n_events", "alarm_no"], dtype="Int64")


class Silence(StatefulProcessor):
    """Tells when a user has done nothing for ``gap`` microseconds, and how often that has been so.

    Events wait in the state, added up per stretch of time no longer than the gap: those
    of one stretch always belong together. A timer stands at the earliest time at which
    the user may have been silent. When the watermark passes it, no event can arrive any
    more that would break the silence; stretches up to it are given out and forgotten,
    and the timer moves on. The number of alarms stays for good, one number per user.
    """

    def __init__(self, gap: int) -> None:
        self._gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._pending = handle.getValueState("pending", _PENDING)
        self._alarms = handle.getValueState("alarms", "n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stretches = self._stretches()
        for batch in rows:
            # However many events a batch holds, a row per stretch is left of them.
            at = batch["micros"]
            found = at.groupby(at // self._gap).agg(["min", "max", "count"])
            for slot, low, high, n in zip(found.index.tolist(), *(found[c].tolist() for c in found.columns)):
                old = stretches.get(slot)
                stretches[slot] = (low, high, n) if old is None else (min(low, old[0]), max(high, old[1]), n + old[2])
        self._keep(stretches)
        yield _rows([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        stretches = self._stretches()
        # The watermark is in milliseconds; nothing before it can still arrive.
        reached = timerValues.getCurrentWatermarkInMs() * 1000
        number = self._alarms.get()[0] if self._alarms.exists() else 0
        done = []
        for first, last, slots in self._visits(stretches):
            if last + self._gap >= reached:
                break
            number += 1
            done.append((None if key[1] else key[0], last, sum(stretches[s][2] for s in slots), number))
            for slot in slots:
                del stretches[slot]
        if done:
            self._alarms.update((number,))
            self._keep(stretches)
        yield _rows(done)

    def close(self) -> None:
        pass

    def _stretches(self) -> dict[int, tuple[int, int, int]]:
        if not self._pending.exists():
            return {}
        return {low // self._gap: (low, high, n) for low, high, n in zip(*self._pending.get())}

    def _visits(self, stretches: dict[int, tuple[int, int, int]]) -> Iterator[tuple[int, int, list[int]]]:
        """Stretches less than a gap apart, in order: first and last time, and the stretches."""
        slots: list[int] = []
        for slot in sorted(stretches):
            if slots and stretches[slot][0] - stretches[slots[-1]][1] >= self._gap:
                yield stretches[slots[0]][0], stretches[slots[-1]][1], slots
                slots = []
            slots.append(slot)
        if slots:
            yield stretches[slots[0]][0], stretches[slots[-1]][1], slots

    def _keep(self, stretches: dict[int, tuple[int, int, int]]) -> None:
        """Write the state, and have the only timer stand behind the earliest visit."""
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if not stretches:
            self._pending.clear()
            return
        columns = zip(*(stretches[slot] for slot in sorted(stretches)))
        self._pending.update(tuple(list(column) for column in columns))
        _, last, _ = next(self._visits(stretches))
        self._handle.registerTimer((last + self._gap) // 1000 + 1)


def silences(delay: str, gap_seconds: int) -> Transform:
    """For each time that a user falls silent for ``gap_seconds``: last event, events since the silence before, and its number.

    An alarm is given once the watermark has passed the end of the silence, whatever the
    deliveries in which the events came. The state of a user is one task's; it holds the
    user's last stretches of time, not the events.
    """

    def job(stream: DataFrame) -> DataFrame:
        # A key of state cannot be null.
        user, unknown = F.coalesce("user_id", F.lit(0).cast("long")).alias("user"), F.col("user_id").isNull().alias("unknown")
        rows = stream.select(user, unknown, "at", F.unix_micros("at").alias("micros")).withWatermark("at", delay)
        alarms = rows.groupBy("user", "unknown").transformWithStateInPandas(
            statefulProcessor=Silence(gap_seconds * 1_000_000), outputStructType=_RESULT, outputMode="Append", timeMode="EventTime"
        )
        last = zone_less(F.timestamp_micros("last"))
        return alarms.select("user_id", last.alias("last_ts"), "n_events", "alarm_no")

    return job
