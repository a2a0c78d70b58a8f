"""Keyed operators whose state is made of parts: a value, a list that only grows at its end, a map of which single entries change.

A batch writes what it adds or changes and no more, and event-time timers drop the state of a key that has fallen silent, so what is kept is
bounded by what is open. They need the RocksDB state store, which :func:`turnlake.streaming.jobs.drain` turns on with ``parts=True``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from turnlake.operators.content import CORRELATED, CallIndex

CLOSED = "request_id string, file string, frame_seq long, raw string, why string"


class _Silence:
    """One timer a key, moved on by every batch: when it expires, the key has been silent."""

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.handle, self.at = handle, handle.getValueState(name, "ms long")

    def move(self, ms: int, watermark: int) -> None:
        ms = max(ms, watermark + 1)
        if self.at.exists():
            before = self.at.get()[0]
            if before == ms:
                return
            self.handle.deleteTimer(before)
        self.handle.registerTimer(ms)
        self.at.update((ms,))

    def clear(self) -> None:
        if self.at.exists():
            self.handle.deleteTimer(self.at.get()[0])
            self.at.clear()


class _Responses(StatefulProcessor):
    """An open response's lines, as a list to which each batch appends its own."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lines = handle.getListState("lines", "file string, frame_seq long, raw string")
        self.silence = _Silence(handle, "until")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = pd.concat(list(rows)).sort_values(["file", "frame_seq"])
        held, out, fresh = self.lines.exists(), [], []
        for r in df.itertuples(index=False):
            fresh.append((r.file, int(r.frame_seq), r.raw))
            if r.ends or not key[0]:
                if held:
                    out += [tuple(x) for x in self.lines.get()]
                    self.lines.clear()
                    held = False
                out, fresh = out + fresh, []
        if fresh:
            self.lines.appendList(fresh)
            self.silence.move(int(df["ts"].max().timestamp() * 1000) + self.idle_ms, timerValues.getCurrentWatermarkInMs())
        else:
            self.silence.clear()
        yield _frame(key[0], out, "end")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = [tuple(x) for x in self.lines.get()]
        self.lines.clear()
        self.silence.at.clear()
        yield _frame(key[0], out, "idle")

    def close(self) -> None:
        pass


def _frame(request: str, lines: list[tuple], why: str) -> pd.DataFrame:
    return pd.DataFrame([(request, *x, why) for x in lines], columns=["request_id", "file", "frame_seq", "raw", "why"])


def closed(frames: DataFrame, late: str = "10 minutes", idle_ms: int = 1_800_000) -> DataFrame:
    """``request_id, file, frame_seq, raw, why``: the lines of every response, once it has ended, or been idle for so long by the watermark.

    Batch operators then see whole responses, and give in a stream what they give on archives. Lines of a batch are in order, and a request's
    next response opens after the end of the one before; lines without a request go by at once. Input: decoded frames that have kept ``raw``;
    rows whose time is null or too late are dropped by the watermark. State is an open response's lines, each written once.
    """
    ends = F.col("ev_type").isin("response.completed", "error") & F.col("event").isNotNull()
    rows = frames.select(F.coalesce("request_id", F.lit("")).alias("request_id"), "ts", "file", "frame_seq", "raw", F.coalesce(ends, F.lit(False)).alias("ends"))
    kept = rows.where("ts is not null").withWatermark("ts", late).groupBy("request_id")
    return kept.transformWithStateInPandas(_Responses(idle_ms), CLOSED, "Append", "EventTime")


class _Calls(StatefulProcessor):
    """A thread's call index, as a map from an entry's number to the entry: a batch writes the entries that it makes, answers or drops.

    Each use of state is a round trip to the JVM, so a thread has one small value beside the map: its clock, how many calls it made, and when its
    timer is due. The timer isn't moved on by a batch. When it is due too early, it is set anew.
    """

    def __init__(self, names: list[str], hours: int, most: int) -> None:
        self.names, self.hours, self.most = names, hours, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, Row(*self.names)
        self.entries = handle.getMapState("entries", "n long", "call string, at long, occurrence int, ref string, answered boolean")
        self.clock = handle.getValueState("clock", "at long, made long, due long")

    def _until(self, clock: int, watermark: int) -> int:
        return max(clock // 1000 + self.hours * 3_600_000, watermark + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self.clock.get()
        clock, made, due = before or (None, 0, None)
        index = CallIndex(self.hours, self.most, clock, made)
        for (n,), entry in sorted(self.entries.iterator()) if before else ():
            index.put(n, list(entry))
        out = []
        for r in sorted(rows, key=lambda r: (r["order"], r["ref"])):
            if r["is_call"]:
                found = index.record(r["call"], r["us"], r["ref"]), None, None
            else:
                match, matched, occurrence = index.lookup(r["call"], r["us"])
                found = occurrence, match, matched
            out.append(self.row(key[0], r["call"], r["is_call"], r["order"], r["ref"], *found))
        for n in index.dropped:
            if n <= made:
                self.entries.removeKey((n,))
        for n in index.changed & index.entries.keys():
            self.entries.updateValue((n,), tuple(index.entries[n]))
        if due is None:
            due = self._until(index.clock, timerValues.getCurrentWatermarkInMs())
            self.handle.registerTimer(due)
        self.clock.update((index.clock, index.made, due))
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        clock, made, _ = self.clock.get()
        watermark = timerValues.getCurrentWatermarkInMs()
        if clock // 1000 + self.hours * 3_600_000 > watermark:
            due = self._until(clock, watermark)
            self.handle.registerTimer(due)
            self.clock.update((clock, made, due))
        else:
            self.entries.clear()
            self.clock.clear()
        yield from ()

    def close(self) -> None:
        pass


def correlate(stream: DataFrame, thread: str, call: str, is_call: str, order: str, ts: str, ref: str, hours: int = 24, most: int = 512, late: str = "10 minutes") -> DataFrame:
    """:func:`turnlake.operators.content.correlate` on a stream, with each thread's call index as its state.

    Batches must come in the rows' order; inside a batch they are put in order. Rows whose time is null, or that come later than ``late``, are
    dropped by the watermark. A thread that has been silent for ``hours`` by the watermark loses its state, which by then holds nothing young.
    """
    names = [thread, call, is_call, order, ref]
    stream = stream.withColumn(ref, F.col(ref).cast("string"))
    kinds = dict(stream.dtypes)
    rows = stream.where(F.col(is_call).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, late)
    known = (F.coalesce(thread, F.lit("")) != "") & (F.coalesce(call, F.lit("")) != "")
    apart = rows.where(~known).select(*names, F.lit(None).cast("int").alias("occurrence"), F.when(~F.col(is_call), "none").alias("match"), F.lit(None).cast("string").alias("matched_ref"))
    keyed = rows.where(known).select(
        F.col(thread).alias("thread"), F.col(call).alias("call"), F.col(is_call).alias("is_call"), F.col(order).alias("order"), F.col(ref).alias("ref"), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"), F.col(ts).alias("ts"),
    ).groupBy("thread")
    out = ", ".join(f"{c} {kinds[c]}" for c in names) + ", " + CORRELATED
    columns = [*names, "occurrence", "match", "matched_ref"]
    return keyed.transformWithState(_Calls(columns, hours, most), out, "Append", "EventTime").unionByName(apart)
