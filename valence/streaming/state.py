"""Keyed state of running streams: the newest rows, the rate of the last minute, and counts since a reset.

State gets no rows of a batch as they come. Each task hands on a part of its own (its
newest rows, or its counts by time since what makes older ones void), so that a key which
all rows share does not bring a batch into one task. A restart goes on from the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from ..functions.arithmetic import to_milli
from ..operators.throughput import SPAN, rate_columns

# Sent to the workers by value: they need Spark and pandas only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MICROS = 1_000_000


# A task's parts are brought together once there are so many rows, or as many as were kept the last time.
_ROWS = 50_000


def _micros(time: pd.Timestamp) -> int:
    return time.value // 1000


def _folded(batches: Iterator[pd.DataFrame], fold: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What ``fold`` keeps of all rows of a task, at most. The work grows with the rows, not with their square."""
    kept, waiting, most = [], 0, _ROWS
    for batch in batches:
        kept.append(fold(batch))
        waiting += len(kept[-1])
        if waiting > most:
            kept = [fold(pd.concat(kept, ignore_index=True))]
            waiting, most = 0, max(_ROWS, len(kept[0]))
    if kept:
        yield fold(pd.concat(kept, ignore_index=True))


# --- newest rows ----------------------------------------------------------------------------------------------------


def _newest(rows: pd.DataFrame, k: int, order: list[str]) -> pd.DataFrame:
    return rows.sort_values(order, ascending=False, kind="stable", na_position="last").head(k)


class _History(StatefulProcessor):
    """The ``k`` newest rows, newest first, as a list."""

    def __init__(self, schema: StructType, k: int, order: list[str]):
        self.schema, self.k, self.order = schema, k, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        names = self.schema.names
        kept = pd.DataFrame(list(self.rows.get()) if self.rows.exists() else [], columns=names)
        # A batch that is run again, or a row that comes twice, stands once.
        for part in rows:
            kept = part[names] if kept.empty else pd.concat([kept, part[names]], ignore_index=True)
            kept = _newest(kept.drop_duplicates(subset=self.order), self.k, self.order)
        self.rows.put([tuple(None if v is pd.NaT else v for v in row) for row in kept.itertuples(index=False, name=None)])
        yield kept.assign(place=range(len(kept)))

    def close(self) -> None:
        pass


def history_stream(messages: DataFrame, k: int, ts: str, number: str) -> DataFrame:
    """The ``k`` newest rows by ``ts`` and ``number`` after each batch, with their ``place`` from 0; update mode.

    Rows without a time are the oldest. Rows with one time and number are one row, as
    where a topic delivers it again. A task hands on ``k`` rows of a batch at most.
    """
    schema, order = messages.schema, [ts, number]

    def newest_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            kept = _newest(batch if kept is None else pd.concat([kept, batch], ignore_index=True), k, order)
        if kept is not None:
            yield kept

    few = messages.mapInPandas(newest_here, schema).withColumn("__all", F.lit(0))
    out = StructType([*schema.fields, StructField("place", IntegerType())])
    return few.groupBy("__all").transformWithStateInPandas(_History(schema, k, order), out, "Update", "None")


# --- rate of the last minute ----------------------------------------------------------------------------------------


class _Rate(StatefulProcessor):
    """Counts by time of the last ``SPAN`` seconds up to the key's newest event."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", StructType([StructField("at", LongType())]), StructType([StructField("n", LongType())]))
        self.newest = handle.getValueState("newest", StructType([StructField("at", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        found: dict[int, int] = {}
        for part in rows:
            for at, n in zip(part["event_ts"], part["n"]):
                found[_micros(at)] = found.get(_micros(at), 0) + int(n)
        before = self.newest.get()[0] if self.newest.exists() else None
        newest = max([*found, *([before] if before is not None else [])])
        since = newest - SPAN * _MICROS
        kept = {at[0]: n[0] for at, n in self.counts.iterator()} if self.counts.exists() else {}
        for at in [at for at in kept if at < since]:
            self.counts.removeKey((at,))
            del kept[at]
        for at, n in found.items():
            if at >= since:  # what came late, but lies within the span, counts
                kept[at] = kept.get(at, 0) + n
                self.counts.updateValue((at,), (kept[at],))
        if newest != before:
            self.newest.update((newest,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(newest // 1000 + 1 + SPAN * 1000)
        yield pd.DataFrame({self.key: [key[0]], "event_ts": [pd.Timestamp(newest, unit="us")], "events_60s": [sum(kept.values())]})

    def handleExpiredTimer(self, key, timers, info) -> Iterator[pd.DataFrame]:
        """No event for a whole span, and none can come: the counts go. What comes later starts a new span."""
        self.counts.clear()
        yield pd.DataFrame({self.key: [], "event_ts": pd.Series([], dtype="datetime64[ns]"), "events_60s": pd.Series([], dtype="int64")})

    def close(self) -> None:
        pass


def _last_span(rows: pd.DataFrame, key: str) -> pd.DataFrame:
    """Counts by time of the last ``SPAN`` seconds of each key: what is older than that counts at no later time either."""
    newest = rows.groupby(key, dropna=False)["event_ts"].transform("max")
    rows = rows[rows["event_ts"] >= newest - pd.Timedelta(seconds=SPAN)]
    return rows.groupby([key, "event_ts"], dropna=False, as_index=False)["n"].sum()


def throughput_now(messages: DataFrame, ts: str = "event_ts", key: str = "source", delay: str = "10 minutes") -> DataFrame:
    """``key, event_ts, events_60s`` and the rates, per key as of its newest event, after each batch that has some; update mode.

    Both ends of the last ``SPAN`` seconds count. Rows without a time, and those later than
    ``delay``, do not count. Of its part of a batch a task hands on a row for each key and
    time of the last span of the key; state holds the times of one span.
    """
    kind = messages.schema[key].dataType.simpleString()
    rows = messages.where(F.col(ts).isNotNull()).select(F.col(key), F.col(ts).alias("event_ts"), F.lit(1).cast("bigint").alias("n"))
    counted = lambda batches: _folded(batches, lambda part: _last_span(part, key))
    sums = rows.mapInPandas(counted, f"`{key}` {kind}, event_ts timestamp, n bigint").withWatermark("event_ts", delay)
    out = StructType([messages.schema[key], StructField("event_ts", TimestampType()), StructField("events_60s", LongType())])
    now = sums.groupBy(key).transformWithStateInPandas(_Rate(key), out, "Update", "EventTime")
    return now.selectExpr(f"`{key}`", "event_ts", "events_60s", *rate_columns("events_60s"))


# --- counts since the last reset ------------------------------------------------------------------------------------

_COUNTS = ["total", "positive", "negative", "neutral", "polarity_milli"]


class _SinceReset(StatefulProcessor):
    """A key's last reset, its counts by time where a reset may still come, and one sum of what is older."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        numbers = StructType([StructField(name, LongType()) for name in _COUNTS])
        at = StructType([StructField("at", LongType())])
        self.times = handle.getMapState("times", at, numbers)
        self.settled = handle.getValueState("settled", numbers)
        self.marks = handle.getValueState("marks", StructType([StructField("reset", LongType()), StructField("upto", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        reset, upto = self.marks.get() if self.marks.exists() else (None, None)
        found: dict[int, list[int]] = {}
        latest = reset
        for part in rows:
            times = [_micros(t) for t in part["event_ts"]]
            for at, is_reset, *counts in zip(times, part["is_reset"], *[part[name] for name in _COUNTS]):
                if is_reset:
                    latest = at if latest is None else max(latest, at)
                else:
                    found[at] = [a + int(b) for a, b in zip(found.get(at, [0] * len(_COUNTS)), counts)]
        known = {at[0]: list(counts) for at, counts in self.times.iterator()} if self.times.exists() else {}
        settled = list(self.settled.get()) if self.settled.exists() else [0] * len(_COUNTS)
        if latest is not None and latest != reset and (upto is None or latest >= upto):
            settled = [0] * len(_COUNTS)  # all that was settled is older than this reset
        for at, counts in found.items():
            known[at] = [a + b for a, b in zip(known.get(at, [0] * len(_COUNTS)), counts)]
        # Times that no reset can reach any more become part of the sum; those before the reset go.
        watermark = timers.getCurrentWatermarkInMs() * 1000
        upto = max(upto or watermark, watermark)
        for at in list(known):
            if latest is not None and at <= latest:
                del known[at]
            elif at < upto:
                settled = [a + b for a, b in zip(settled, known.pop(at))]
        before = {at[0] for at, _ in self.times.iterator()} if self.times.exists() else set()
        for at in before - set(known):
            self.times.removeKey((at,))
        for at in known:
            if at in found or at not in before:
                self.times.updateValue((at,), tuple(known[at]))
        self.settled.update(tuple(settled))
        self.marks.update((latest, upto))
        sums = [sum(column) for column in zip(settled, *known.values())]
        yield pd.DataFrame({self.key: [key[0]]} | {name: [n] for name, n in zip(_COUNTS, sums)})

    def close(self) -> None:
        pass


def _after_resets(rows: pd.DataFrame, key: str) -> pd.DataFrame:
    """The last reset of each key and counts by time after it: an older row that came in time for this reset is taken back by it."""
    last = rows["event_ts"].where(rows["is_reset"]).groupby(rows[key], dropna=False).transform("max")
    rows = rows[(rows["event_ts"] > last) | last.isna() | rows["is_reset"] & (rows["event_ts"] == last)]
    return rows.groupby([key, "event_ts", "is_reset"], dropna=False, as_index=False)[_COUNTS].sum()


def since_reset(scored: DataFrame, key: str = "source", ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    """Counts per key since its last reset (rows with ``is_reset``), after each batch that has some of it; update mode.

    The result does not depend on the order of arrival, as long as nothing is later than
    ``delay``; later rows do not count. A reset counts events after its time only; one that
    is older than the last changes nothing. Rows without a time do not count. Of its part of
    a batch a task hands on the last reset of each key and one row for each time after it,
    so no task gets a batch.
    """
    kind = scored.schema[key].dataType.simpleString()
    counted = lambda batches: _folded(batches, lambda part: _after_resets(part, key))

    event = "CASE WHEN NOT is_reset THEN 1L ELSE 0L END"
    one = lambda name: f"CASE WHEN NOT is_reset AND sentiment = '{name}' THEN 1L ELSE 0L END AS {name.lower()}"
    rows = scored.where(F.col(ts).isNotNull()).selectExpr(
        f"`{key}`", f"{ts} AS event_ts", "coalesce(is_reset, false) AS is_reset", f"{event} AS total", one("Positive"), one("Negative"), one("Neutral"),
        f"CASE WHEN NOT is_reset THEN {to_milli('polarity')} ELSE 0L END AS polarity_milli",
    )
    numbers = ", ".join(f"{name} bigint" for name in _COUNTS)
    sums = rows.mapInPandas(counted, f"`{key}` {kind}, event_ts timestamp, is_reset boolean, {numbers}").withWatermark("event_ts", delay)
    out = StructType([scored.schema[key], *[StructField(name, LongType()) for name in _COUNTS]])
    return sums.groupBy(key).transformWithStateInPandas(_SinceReset(key), out, "Update", "EventTime")
