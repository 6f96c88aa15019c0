"""Sessions by keyed inactivity timers, over a stream or over stored rows.

One state per key: the open session (start, last event, count) and a timer at last
event + gap. An ordered event that comes no later than the timer updates the session
and resets the timer; a later event means the timer expired first, which emits the
session and opens the next one.

``timers`` and ``expired`` are the machine; both ways of running it go through them.
``timer_sessions`` runs it over stored rows. A hot key isn't one task:
rows are split by (key, time bucket), each part is run through the machine, and only the
sessions that come within one gap of a bucket's edge – at most two for each key and
bucket – go through the machine once more, keyed by key alone, to be joined across
buckets. ``stream_sessions`` runs it in Structured Streaming with event-time timers.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

GAP_MS = 20 * 60 * 1000
BUCKET_MS = 24 * 3600 * 1000


def timers(ends: np.ndarray, bounds: np.ndarray, gap_ms: int) -> np.ndarray:
    """Where each event sets its key's timer: a gap after the latest end so far.

    ``bounds`` are the keys' first rows and the number of rows. Intervals may lie inside
    earlier ones, which leave the timer where it is.
    """
    reach = ends.astype(np.int64) + gap_ms
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        np.maximum.accumulate(reach[a:b], out=reach[a:b])
    return reach


def expired(starts: np.ndarray, timer: np.ndarray) -> np.ndarray:
    """Whether the timer that the row before has set fires before the row's event; never for the first row."""
    return np.append(False, starts[1:] > timer[:-1])


def run_timers(batches: Iterator[pa.RecordBatch], gap_ms: int, key_columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The state machine over intervals (start_ms, end_ms, events) that come ordered by key and start.

    An event is an interval of length 0. State is carried from batch to batch, so a key
    may span any number of batches; memory is one batch.
    """
    open_key: tuple | None = None
    start = end = events = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        # Keys as dictionary codes: comparing neighbours then costs one vector operation a column.
        keys = [batch.column(batch.schema.get_field_index(k)) for k in key_columns]
        s = batch.column(batch.schema.get_field_index("start_ms")).to_numpy(zero_copy_only=False)
        e = batch.column(batch.schema.get_field_index("end_ms")).to_numpy(zero_copy_only=False)
        n = batch.column(batch.schema.get_field_index("events")).to_numpy(zero_copy_only=False)
        rows = batch.num_rows
        new_key = np.zeros(rows, bool)
        for k in keys:
            codes = k.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            new_key[1:] |= codes[1:] != codes[:-1]
        new_key[0] = True
        bounds = np.append(np.flatnonzero(new_key), rows)
        timer = timers(e, bounds, gap_ms) if (s != e).any() else e.astype(np.int64) + gap_ms
        first_key = tuple(k[0].as_py() for k in keys)
        if first_key == open_key:
            timer[: bounds[1]] = np.maximum(timer[: bounds[1]], end + gap_ms)
        over = new_key | expired(s, timer)
        if first_key == open_key and s[0] <= end + gap_ms:
            over[0] = False
        reach = timer - gap_ms
        cuts = np.flatnonzero(over)
        heads = np.append(cuts, rows)
        counted = np.concatenate([[0], np.cumsum(n)])
        out_keys: list[list[Any]] = [[] for _ in keys]
        out: list[tuple[int, int, int]] = []
        if open_key is not None:
            upto = int(heads[0])  # rows that still belong to the open session
            if upto:
                end = int(max(end, reach[upto - 1]))
                events += int(counted[upto])
            if len(cuts):
                for o, v in zip(out_keys, open_key, strict=True):
                    o.append(v)
                out.append((start, end, events))
        if len(cuts):
            a, b = heads[:-1], heads[1:]
            done = slice(0, len(cuts) - 1)
            ends, sums = reach[b - 1], counted[b] - counted[a]
            columns = []
            for i, k in enumerate(keys):
                closed = k.take(pa.array(a[done]))
                columns.append(pa.concat_arrays([pa.array(out_keys[i], type=k.type), closed]) if out_keys[i] else closed)
            head = np.array(out, np.int64).reshape(-1, 3)
            for j, values in enumerate((s[a], ends, sums)):
                columns.append(pa.array(np.concatenate([head[:, j], np.asarray(values, np.int64)[done]])))
            last = int(a[-1])
            open_key = tuple(k[last].as_py() for k in keys)
            start, end, events = int(s[last]), int(ends[-1]), int(sums[-1])
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, names=[*key_columns, "start_ms", "end_ms", "events"])
    if open_key is not None:  # the end of the input fires the last timer
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([v]) for v in open_key], *[pa.array([v], pa.int64()) for v in (start, end, events)]],
            names=[*key_columns, "start_ms", "end_ms", "events"],
        )


def timer_sessions(events: DataFrame, key: str, time_ms: str, gap_ms: int = GAP_MS, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """(key, start_ms, end_ms, duration_ms, events): one row per session of stored rows.

    Rows without key or time aren't events. Events exactly ``gap_ms`` apart share a
    session; repeated rows and ties count each. An empty input gives no session.
    Other columns are ignored.
    """
    if bucket_ms <= 2 * gap_ms:
        raise ValueError("a bucket has to be longer than two gaps")
    kind = events.schema[key].dataType.simpleString()
    rows = events.where(F.col(key).isNotNull() & F.col(time_ms).isNotNull()).select(
        F.col(key).alias("k"),
        F.floor(F.col(time_ms) / F.lit(bucket_ms)).cast("long").alias("b"),
        F.col(time_ms).cast("long").alias("start_ms"),
        F.col(time_ms).cast("long").alias("end_ms"),
        F.lit(1).cast("long").alias("events"),
    )
    sessions = "start_ms long, end_ms long, events long"
    parts = (
        rows.repartition("k", "b")
        .sortWithinPartitions("k", "b", "start_ms")
        .mapInArrow(lambda it: run_timers(it, gap_ms, ["k", "b"]), f"k {kind}, b long, {sessions}")
    )
    low, high = F.col("b") * bucket_ms, (F.col("b") + 1) * bucket_ms
    at_edge = (F.col("start_ms") - low <= gap_ms) | (high - F.col("end_ms") <= gap_ms)
    tagged = parts.withColumn("edge", at_edge)
    # One exchange carries both kinds: closed sessions pass the second machine as they are.
    joined = tagged.repartition(
        F.col("k"), F.when(F.col("edge"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("b"), F.lit(1024))).cast("int")
    )
    flat = joined.select("k", F.when(F.col("edge"), F.lit(0)).otherwise(F.col("start_ms")).cast("long").alias("b"), "start_ms", "end_ms", "events")
    final = flat.sortWithinPartitions("k", "b", "start_ms").mapInArrow(
        lambda it: run_timers(it, gap_ms, ["k", "b"]), f"k {kind}, b long, {sessions}"
    )
    return final.select(
        F.col("k").alias(key), "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), "events"
    )


class SessionTimer(StatefulProcessor):
    """The same machine for ``transformWithStateInPandas`` with event-time timers."""

    def __init__(self, gap_ms: int = GAP_MS):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start_ms long, end_ms long, events long")

    def _emit(self, key: Any, done: list[tuple[int, int, int]]) -> Iterator[pd.DataFrame]:
        if done:
            yield pd.DataFrame(
                {"key": [key[0]] * len(done), "start_ms": [d[0] for d in done], "end_ms": [d[1] for d in done], "events": [d[2] for d in done]}
            )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Several sessions can be open until the watermark passes: late events may still join them.
        spans = [tuple(map(int, r)) for r in self.open.get()] if self.open.exists() else []
        for pdf in rows:
            spans += [(int(t), int(t), 1) for t in pdf["time_ms"]]
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if spans:
            s, e, n = np.array(sorted(spans), np.int64).T
            timer = timers(e, np.array([0, len(s)]), self.gap_ms)
            heads = np.flatnonzero(expired(s, timer) | (np.arange(len(s)) == 0))
            last = np.append(heads[1:], len(s)) - 1
            self.open.put(list(zip(s[heads].tolist(), (timer[last] - self.gap_ms).tolist(), np.add.reduceat(n, heads).tolist(), strict=True)))
            for t in timer[last].tolist():
                self.handle.registerTimer(t + 1)
        else:
            self.open.clear()
        yield from ()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        spans = [tuple(map(int, r)) for r in self.open.get()] if self.open.exists() else []
        done = [s for s in spans if s[1] + self.gap_ms < at]
        left = [s for s in spans if s[1] + self.gap_ms >= at]
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        yield from self._emit(key, done)

    def close(self) -> None:
        pass


def stream_sessions(events: DataFrame, key: str, time_column: str, gap_ms: int = GAP_MS, watermark: str = "1 hour") -> DataFrame:
    """Sessions of a stream: (key, start_ms, end_ms, events), each emitted once, when its timer expires.

    ``time_column`` is a timestamp. Events behind the watermark are dropped by Spark, as
    in any watermarked query; rows without key or time are no events.
    """
    kind = events.schema[key].dataType.simpleString()
    rows = (
        events.where(F.col(key).isNotNull() & F.col(time_column).isNotNull())
        .select(F.col(key).alias("key"), F.col(time_column).alias("event_time"), F.unix_millis(time_column).alias("time_ms"))
        .withWatermark("event_time", watermark)
    )
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=SessionTimer(gap_ms),
        outputStructType=f"key {kind}, start_ms long, end_ms long, events long",
        outputMode="Append",
        timeMode="EventTime",
    )
