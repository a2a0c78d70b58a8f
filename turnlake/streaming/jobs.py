"""Structured Streaming twins of the batch operators. Time is the data's own."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from turnlake.operators.content import CORRELATED, CallIndex
from turnlake.operators.turns import segment
from turnlake.sources.frames import TERMINAL
from turnlake.sources.tables import checkpointed, committed, discard, write_batch


def tumbling_counts(stream: DataFrame, ts: str, step: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Counts in tumbling windows, closed by the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, step), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("step"), *keys, "n")


def first_seen(stream: DataFrame, ts: str, keys: list[str], late: str = "24 hours") -> DataFrame:
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def series_deltas(stream: DataFrame, series: list[str], order: str, calls: str, counters: list[str], ts: str, gap_ms: int = 1_800_000, keep_ms: int = 168 * 3_600_000, late: str = "10 minutes") -> DataFrame:
    """What each reading adds to its series' cumulative counters: ``series, order, reset, baseline_reset, delta_<counter>``.

    State is a series' last reading. A reading counts in full without one, after a gap, or when its calls didn't grow; one without calls counts in
    full and is no baseline. A series that has had no reading for ``keep_ms`` before the watermark loses its state. Rows of a batch are ordered by
    ``order``; null counters are zero, and rows without a time are dropped by the watermark.
    """
    names = [f"delta_{c}" for c in counters]

    def run(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else None
        df = pd.concat(list(frames)).sort_values(order)
        rows = []
        for at, when, made, *values in zip(df[order], df[ts], df[calls], *[df[c] for c in counters], strict=True):
            now = int(when.timestamp() * 1000)
            values = [0.0 if pd.isna(v) else float(v) for v in values]
            cold = last is None or now - last[1] > gap_ms
            reset = cold or pd.isna(made) or float(made) <= last[0]
            rows.append([*key, at, bool(reset), bool(cold), *(v if reset else v - b for v, b in zip(values, [0.0] * len(values) if reset else last[2], strict=True))])
            if not pd.isna(made):
                last = (float(made), now, values)
        if last is not None:
            state.update(last)
            state.setTimeoutTimestamp(max(last[1] + keep_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(rows, columns=[*series, order, "reset", "baseline_reset", *names])

    kinds = dict(stream.dtypes)
    out = ", ".join([*(f"{k} {kinds[k]}" for k in series), f"{order} {kinds[order]}", "reset boolean", "baseline_reset boolean", *(f"{x} double" for x in names)])
    rows = stream.select(*series, order, ts, F.col(calls).cast("double").alias(calls), *[F.col(c).cast("double").alias(c) for c in counters if c != calls])
    return rows.withWatermark(ts, late).groupBy(*series).applyInPandasWithState(run, out, "calls double, last long, counters array<double>", "append", "EventTimeTimeout")


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def _state_store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """A query takes the store that is set when it starts; afterwards the setting is as it was."""
    before = spark.conf.get(_STORE, None)
    if provider:
        spark.conf.set(_STORE, provider)
    try:
        yield
    finally:
        if provider:
            spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def drain(
    out: DataFrame, folder: str, mode: str = "append", each: Callable[[DataFrame], DataFrame] | None = None, parts: bool = False, name: str | None = None
) -> DataFrame:
    """Run a query over all that is there into a Parquet table and read it. Each batch overwrites its own partition, so a retry is harmless.

    ``each`` is applied to every batch, and its result is what is kept. ``parts`` is for operators of :mod:`turnlake.streaming.state`. A query
    that has a ``name`` goes on, in its folder, from where the last one of that name stopped.
    """
    spark: SparkSession = out.sparkSession
    base = f"{folder.rstrip('/')}/turnlake-stream-{name or uuid.uuid4().hex}"

    def write(df: DataFrame, batch: int) -> None:
        df = each(df) if each else df
        df.write.mode("overwrite").parquet(f"{base}/out/batch={batch}")

    sink: Callable[[DataFrame, int], None] = write
    with _state_store(spark, _ROCKS if parts else None):
        query = out.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start()
        query.awaitTermination()
    schema = each(spark.createDataFrame([], out.schema)).schema if each else out.schema
    return spark.read.schema(schema).parquet(f"{base}/out")


def deliver(stream: DataFrame, tables: Callable[[DataFrame], dict[str, DataFrame]], folder: str, name: str | None = None) -> str:
    """Run a stream over all that is there into several tables; returns their folder, for :func:`turnlake.sources.tables.committed`.

    A batch's tables come into view together. A run that failed goes on, under its ``name``, with the batch that failed.
    """
    base = f"{folder.rstrip('/')}/turnlake-delivery-{name or uuid.uuid4().hex}"

    def write(df: DataFrame, batch: int) -> None:
        kept = df.persist()  # read once for each table
        try:
            write_batch(tables(kept), f"{base}/out", batch)
        finally:
            kept.unpersist()

    sink: Callable[[DataFrame, int], None] = write
    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    return f"{base}/out"


def attach_stream(turns: DataFrame, logs: DataFrame, key: str, ts: str, log_ts: str, within: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """Two streams, each row of ``turns`` with every row of ``logs`` of its key that is within so much of its time: the log's columns as ``log``.

    A row without one comes with a null ``log`` once the watermark of both streams is past what could still match it; state is bounded by the
    same. Null keys match nothing. Rows without a time, or beyond ``late``, are dropped by the watermark; logs that come too late to be joined
    are for :func:`corrections`.
    """
    left = turns.where(F.col(ts).isNotNull()).withWatermark(ts, late)
    right = logs.where(F.col(log_ts).isNotNull()).select(F.col(key).alias("_key"), F.col(log_ts).alias("_ts"), F.struct(*logs.columns).alias("log")).withWatermark("_ts", late)
    gap = F.expr(f"interval {within}")
    near = (F.col(key) == F.col("_key")) & (F.col("_ts") >= F.col(ts) - gap) & (F.col("_ts") <= F.col(ts) + gap)
    return left.join(right, near, "leftOuter").drop("_key", "_ts")


def corrections(attached: DataFrame, logs: DataFrame, key: str, newest: str) -> DataFrame:
    """``key, log, was``: the newest log of every key in ``attached`` (what :func:`attach_stream` delivered) to which a later one has come.

    ``was`` is what had been delivered: ``hit``, or ``miss``. Equal keys are one. With these laid over it, what was delivered is the batch join.
    """
    held = attached.groupBy(key).agg(F.max(F.col("log")[newest]).alias("_held"))
    last = logs.groupBy(key).agg(F.max_by(F.struct(*logs.columns), newest).alias("log"))
    out = held.join(last, key).where(F.col("_held").isNull() | (F.col("log")[newest] > F.col("_held")))
    return out.select(key, "log", F.when(F.col("_held").isNull(), "miss").otherwise("hit").alias("was"))


def cap_stream(stream: DataFrame, field: str, order: list[str], cap: int, folder: str, name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`turnlake.operators.metrics.cap_values` on a stream, in order of arrival: its rows, and ``(field, distinct, rejected)``.

    The first ``cap`` distinct values are let through and stay so; from then on every row with another one is rewritten to ``_other`` and counted.
    Batches must come in order; inside a batch ``order`` decides. What was let through is a table of at most ``cap`` rows that a batch reads,
    adds to and delivers with its rows, so a batch that is tried again finds it as it was. Null and empty values pass, and count for nothing.
    """
    spark = stream.sparkSession
    base = f"{folder.rstrip('/')}/turnlake-cap-{name or uuid.uuid4().hex}"
    admitted = StructType([StructField("_v", stream.schema[field].dataType)])
    report = "field string, distinct long, rejected long"

    def write(df: DataFrame, batch: int) -> None:
        before = committed(spark, f"{base}/out", "admitted", admitted)
        new = df.where(F.col(field) != "").groupBy(F.col(field).alias("_v")).agg(F.min(F.struct(*order)).alias("_o")).join(before, "_v", "left_anti")
        new = new.orderBy("_o").limit(max(0, cap - before.count())).select("_v").persist()
        known = before.union(new)
        out = df.join(F.broadcast(known.withColumnRenamed("_v", "_known")), F.col(field) == F.col("_known"), "left")  # at most cap rows
        plain = F.coalesce(F.col(field), F.lit("")) == ""
        over = ~plain & F.col("_known").isNull()
        rows = out.withColumn("_over", over).withColumn(field, F.when(over, "_other").otherwise(F.col(field))).drop("_known").persist()
        counts = rows.agg(F.lit(field).alias("field"), F.lit(new.count()).cast("long").alias("distinct"), F.count_if("_over").alias("rejected"))
        write_batch({"rows": rows.drop("_over"), "admitted": new, "report": counts}, f"{base}/out", batch)
        rows.unpersist()
        new.unpersist()

    sink: Callable[[DataFrame, int], None] = write
    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    total = committed(spark, f"{base}/out", "report", report).groupBy("field").agg(F.sum("distinct").alias("distinct"), F.sum("rejected").alias("rejected"))
    return committed(spark, f"{base}/out", "rows", stream.schema), total


def correlate_stream(stream: DataFrame, thread: str, call: str, is_call: str, order: str, ts: str, ref: str, folder: str, hours: int = 24, most: int = 512, late: str = "10 minutes", name: str | None = None) -> DataFrame:
    """:func:`turnlake.operators.content.correlate` on a stream of large batches: a batch's threads are folded over sorted rows, as in a batch job.

    What the threads still hold is part of what a batch delivers, and the next one reads it from there; so a batch that is tried again finds it as
    it was. :func:`turnlake.streaming.state.correlate` keeps it in a state store instead, at several round trips for each thread of a batch: for
    batches that touch few of many threads. Batches must come in the rows' order; inside a batch they are put in order. Rows whose time is null, or
    that lie more than ``late`` before the newest time in the threads of the batches before, are dropped. A thread that has been silent for ``hours``
    by that clock isn't held on. A task holds a batch of rows and one thread's calls, at most ``most``.
    """
    spark = stream.sparkSession
    base = f"{folder.rstrip('/')}/turnlake-calls-{name or uuid.uuid4().hex}"
    names = [thread, call, is_call, order, ref]
    kinds = dict(stream.withColumn(ref, F.col(ref).cast("string")).dtypes)
    # a row of what is held has a number: 0 for a thread's clock, else the call's
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + f", {CORRELATED}, _n long, _us long, _answered boolean"

    def fold(batches: Iterator[pa.RecordBatch], since: int | None) -> Iterator[pa.RecordBatch]:
        def left(who, index: CallIndex | None) -> list[tuple]:
            if index is None or since is not None and index.clock + hours * 3_600_000_000 <= since:
                return []
            calls = [(who, of, None, None, name, occurrence, None, None, n, at, answered) for n, (of, at, occurrence, name, answered) in index.entries.items()]
            return [(who, None, None, None, None, None, None, None, 0, index.clock, None), *calls]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(types), types, strict=True)], columns)

        last, index, types, columns = None, None, [], []
        for batch in batches:
            types, columns, out = batch.schema.types, batch.schema.names, []
            for who, of, calls, at, own, occurrence, _, _, n, us, answered in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if index is None or who != last:
                    out += left(last, index)
                    last, index = who, CallIndex(hours, most)
                if n == 0:
                    index.clock = us
                elif n is not None:
                    index.put(n, [of, us, occurrence, own, answered])
                    index.made = n
                elif calls:
                    out.append((who, of, calls, at, own, index.record(of, us, own), None, None, None, None, None))
                else:
                    match, matched, occurrence = index.lookup(of, us)
                    out.append((who, of, calls, at, own, occurrence, match, matched, None, None, None))
            yield pack(out)
        yield from [pack(left(last, index))] if types else []

    def write(df: DataFrame, batch: int) -> None:
        held = committed(spark, f"{base}/out", "rows", schema, newest=True).where("_n is not null")
        since = held.agg(F.unix_micros(F.timestamp_micros(F.max(F.when(F.col("_n") == 0, F.col("_us")))) - F.expr(f"interval {late}"))).first()[0]
        blank = {c: F.lit(None).cast(t) for c, t in (("occurrence", "int"), ("match", "string"), ("matched_ref", "string"), ("_n", "long"), ("_us", "long"), ("_answered", "boolean"))}
        rows = df.where(F.col(is_call).isNotNull() & F.col(ts).isNotNull()).withColumn(ref, F.col(ref).cast("string")).select(*names, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
        if since is not None:
            rows = rows.where(F.col("_us") > since)
        known = (F.coalesce(thread, F.lit("")) != "") & (F.coalesce(call, F.lit("")) != "")
        apart = rows.where(~known).withColumns(blank | {"match": F.when(~F.col(is_call), "none")})
        rows = held.unionByName(rows.where(known).withColumns({c: v for c, v in blank.items() if c != "_us"}))
        rows = rows.repartition(thread).sortWithinPartitions(thread, F.asc_nulls_last("_n"), order, ref)
        done = rows.mapInArrow(lambda batches: fold(batches, since), schema)
        write_batch({"rows": done.unionByName(apart)}, f"{base}/out", batch)

    sink: Callable[[DataFrame, int], None] = write
    stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    return committed(spark, f"{base}/out", "rows", schema).where("_n is null").drop("_n", "_us", "_answered")


def close_stream(frames: DataFrame, each: Callable[[DataFrame], DataFrame], folder: str, late: str = "10 minutes", idle_ms: int = 1_800_000, name: str | None = None) -> DataFrame:
    """What ``each`` gives of the decoded frames of responses that have ended, or been idle for ``idle_ms``, batch by batch, in large batches.

    Open responses' frames are part of what a batch delivers, and the next one reads them from there; so a batch that is tried again finds them as
    they were. :func:`turnlake.streaming.state.closed` keeps lines in a state store instead, at several round trips for each response: for batches
    that touch few of many. The clock is the newest time of the batches so far. Frames whose time is null, or that lie ``late`` or more before the
    clock of the batches before, are dropped; a response is idle when its newest frame lies that long before the clock less ``late``. Frames without a request go by at once.
    """
    spark = frames.sparkSession
    base = f"{folder.rstrip('/')}/turnlake-open-{name or uuid.uuid4().hex}"
    empty = spark.createDataFrame([], frames.schema)
    none = F.coalesce("request_id", F.lit("")) == ""

    def write(df: DataFrame, batch: int) -> None:
        held = committed(spark, f"{base}/out", "held", frames.schema, newest=True)
        before = committed(spark, f"{base}/out", "clock", "clock long", newest=True).agg(F.max("clock")).first()[0]
        mark = lambda us: F.timestamp_micros(F.lit(us)) - F.expr(f"interval {late}")
        fresh = df.where("ts is not null") if before is None else df.where(F.col("ts") > mark(before))
        w = Window.partitionBy("request_id", "instance")
        ends = F.coalesce(F.col("ev_type").isin(*TERMINAL) & F.col("event").isNotNull(), F.lit(False))
        whole = segment(held.unionByName(fresh)).withColumns({"_ended": F.max(ends).over(w), "_last": F.max("ts").over(w)})
        rows = checkpointed(whole.unionByName(fresh.where(none).withColumn("_ended", F.lit(True)), allowMissingColumns=True))
        clock = max((us for us in (before, rows.agg(F.max(F.unix_micros("ts"))).first()[0]) if us is not None), default=None)
        idle = F.lit(False) if clock is None else F.coalesce(F.unix_millis("_last") + idle_ms <= F.unix_millis(mark(clock)), F.lit(False))
        over = F.col("_ended") | idle
        kept = lambda x: rows.where(x).select(*frames.columns)
        write_batch({"rows": each(kept(over)), "held": kept(~over), "clock": spark.createDataFrame([(clock,)], "clock long")}, f"{base}/out", batch)
        discard(rows)

    sink: Callable[[DataFrame, int], None] = write
    frames.writeStream.option("checkpointLocation", f"{base}/checkpoint").foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    return committed(spark, f"{base}/out", "rows", each(empty).schema)


def assemble(frames: DataFrame, late: str = "10 minutes", idle_ms: int = 1_800_000) -> DataFrame:
    """Responses as they end: ``request_id, status, frames, bytes, model, output_tokens``.

    State is one small row an open response. A terminal event emits it and ends it; without one it is emitted as incomplete once the
    watermark is past its last frame by the idle time.
    """
    get = F.get_json_object
    model = F.coalesce(get("event", "$.response.model"), get("event", "$.model"))
    rows = frames.where("request_id <> ''").select(
        "request_id", "ts", "file", "frame_seq", "ev_type", F.octet_length("payload_text").cast("long").alias("size"), model.alias("model"),
        get("event", "$.response.usage.output_tokens").try_cast("long").alias("tokens"), get("event", "$.response.status").alias("state"),
    )
    columns = ["request_id", "status", "frames", "bytes", "model", "output_tokens"]

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            n, size, model_, tokens = state.get
            state.remove()
            yield pd.DataFrame([[key[0], "incomplete", n, size, model_, tokens]], columns=columns)
            return
        n, size, model_, tokens = state.get if state.exists else (0, 0, None, None)
        out, open_ = [], state.exists
        df = pd.concat(list(batches)).sort_values(["file", "frame_seq"])
        for r in df.itertuples(index=False):
            n, size, open_ = n + 1, size + (0 if pd.isna(r.size) else int(r.size)), True
            model_ = r.model if isinstance(r.model, str) else model_
            tokens = tokens if pd.isna(r.tokens) else int(r.tokens)
            if r.ev_type in ("response.completed", "error"):
                status = "error" if r.ev_type == "error" else r.state if isinstance(r.state, str) else "completed"
                out.append([key[0], status, n, size, model_, tokens])
                n, size, model_, tokens, open_ = 0, 0, None, None, False
        if open_:
            state.update((n, size, model_, tokens))
            state.setTimeoutTimestamp(max(int(df["ts"].max().timestamp() * 1000) + idle_ms, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=columns).astype({"output_tokens": "Int64"})

    out = "request_id string, status string, frames long, bytes long, model string, output_tokens long"
    kept = "frames long, bytes long, model string, tokens long"
    return rows.withWatermark("ts", late).groupBy("request_id").applyInPandasWithState(run, out, kept, "append", "EventTimeTimeout")


def health(frames: DataFrame) -> DataFrame:
    """One row about a batch of frames: lines, undecodable ones, open requests, and the time of the newest frame."""
    ended = F.col("ev_type").isin("response.completed", "error")
    return frames.agg(
        F.count("*").alias("lines"), F.count_if(~F.col("decode_ok")).alias("undecodable"), F.count_if(F.col("is_delta")).alias("deltas"),
        (F.countDistinct("request_id") - F.countDistinct(F.when(ended, F.col("request_id")))).alias("open"), F.max("ts").alias("newest"),
    )
