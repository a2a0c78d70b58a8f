"""Calls and outputs by thread: the batch fold, its stream with state, and what happens without a thread, without a time and at the limits."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta, timezone

import pytest

from turnlake.operators import content
from turnlake.plans import live as plans
from turnlake.sources import frames as wire
from turnlake.sources.tables import committed
from turnlake.streaming import jobs, state

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
ROWS = "thread string, call_id string, is_call boolean, o long, ts timestamp, ref string"
NAMES = ("thread", "call_id", "is_call", "o", "ts", "ref")


def direct(rows, hours, most):
    """A plain list for each thread, scanned for every row."""
    age, threads, clocks, out = timedelta(hours=hours), {}, {}, []
    for thread, call, is_call, o, ts, ref in sorted((r for r in rows if r[2] is not None), key=lambda r: r[3]):
        if not thread or not call:
            out.append((thread, call, is_call, o, ref, None, None if is_call else "none", None))
            continue
        held = threads.setdefault(thread, [])
        clock = clocks[thread] = max([t for t in (clocks.get(thread), ts) if t], default=None)
        held[:] = [e for e in held if e[1] is None or clock is None or e[1] >= clock - age]
        if is_call:
            occurrence = 1 + max((e[2] for e in held if e[0] == call), default=0)
            held.append([call, ts, occurrence, ref, False])
            held[:] = [e for e in held if e[1] is None or e[1] >= clock - age][-most:]
            out.append((thread, call, is_call, o, ref, occurrence, None, None))
        else:
            open_ = [e for e in held if e[0] == call and not e[4]]
            if len(open_) == 1:
                open_[0][4] = True
            out.append((thread, call, is_call, o, ref, open_[0][2] if len(open_) == 1 else None, ["none", "exact"][len(open_)] if len(open_) < 2 else "ambiguous", open_[0][3] if len(open_) == 1 else None))
    return Counter(out)


def made(seed, n, times=True):
    rng, ts, rows = random.Random(seed), T0, []
    for i in range(n):
        ts += timedelta(minutes=rng.choice([1, 5, 90, 400]))
        at = None if times and rng.random() < 0.05 else ts - timedelta(hours=rng.choice([0, 0, 0, 3, 30]) if times else 0)
        rows.append((rng.choice(["a", "b", "c", "", None]), rng.choice(["x", "y", "z", "", None]), rng.choice([True, True, False, False, None]), i, at, f"r{i}"))
    return rows


@pytest.mark.parametrize(("hours", "most"), [(24, 512), (6, 3), (1, 1)])
def test_correlation_equals_a_direct_fold(spark, hours, most):
    rows = made(hours, 600)
    got = content.correlate(spark.createDataFrame(rows, ROWS).repartition(7), *NAMES, hours=hours, most=most)
    expected = direct(rows, hours, most)
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert {e[6] for e in expected} >= {None, "none", "exact"} and (most < 9 or "ambiguous" in {e[6] for e in expected})
    assert max(e[5] or 0 for e in expected) > (1 if most > 9 else 0)


def test_a_stream_of_mixed_batches_correlates_as_a_batch_does_and_goes_on_after_a_stop(spark, tmp_path):
    rows = made(5, 240, times=False)
    rng, parts = random.Random(2), [rows[:50], rows[50:51], rows[51:140], rows[140:]]

    def put(k):
        mixed = rng.sample(parts[k], len(parts[k]))
        spark.createDataFrame(mixed, ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return jobs.drain(state.correlate(stream, *NAMES, hours=20, most=4), str(tmp_path), parts=True, name="calls")

    put(0)
    put(1)
    run()
    put(2)
    put(3)
    assert Counter(tuple(r) for r in run().select(*content_columns()).collect()) == direct(rows, 20, 4)


def test_a_fold_of_large_batches_holds_what_threads_hold_and_goes_on_after_a_stop(spark, tmp_path):
    rows = made(5, 240, times=False) + [("d", "x", True, 240, T0 + timedelta(days=99), "r240"), ("d", "x", False, 241, T0 + timedelta(days=99), "r241")]
    rng, parts = random.Random(2), [rows[:50], rows[50:51], rows[51:140], rows[140:240], rows[240:]]

    def put(k):
        spark.createDataFrame(rng.sample(parts[k], len(parts[k])), ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return jobs.correlate_stream(stream, *NAMES, folder=str(tmp_path), hours=20, most=4, name="calls")

    for k in range(5):
        put(k)
        if k in (1, 4):
            got = run()
    assert Counter(tuple(r) for r in got.select(*content_columns()).collect()) == direct(rows, 20, 4)
    held = committed(spark, str(tmp_path / "turnlake-calls-calls" / "out"), "rows", "thread string, ref string, _n long", newest=True).where("_n is not null")
    assert 0 < held.where("_n > 0").groupBy("thread").count().agg({"count": "max"}).first()[0] <= 4  # and no results of other batches


def test_batches_of_many_rows_are_files_of_several_tasks_and_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(plans, "BATCH_ROWS", 10)
    some = [*range(120), *[500] * 3]  # the second and third batch are empty, the last has fewer rows than files
    stream, folder = plans._batches(spark, spark.createDataFrame([(i,) for i in some], "i long"), "i", 4)
    seen = []
    write = stream.writeStream.option("checkpointLocation", f"{folder}/c").foreachBatch(lambda df, _: seen.append(sorted(r[0] for r in df.collect())))
    write.trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(120)), [], [], [500] * 3]
    assert spark.read.parquet(f"{folder}/rows").where("i < 120").select("_metadata.file_name").distinct().count() == 4


def content_columns():
    return ["thread", "call_id", "is_call", "o", "ref", "occurrence", "match", "matched_ref"]


def test_threads_that_fall_silent_lose_their_state(spark, tmp_path):
    at = lambda h: T0 + timedelta(hours=h)
    batches = [[("a", "x", True, 1, at(0), "1"), ("b", "x", True, 2, at(0), "2")], [("b", "y", True, 3, at(40), "3")], [("b", "y", False, 4, at(41), "4")], [("a", "x", True, 5, at(42), "5"), ("a", "x", False, 6, at(43), "6")]]
    for rows in batches:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.drain(state.correlate(stream, *NAMES), str(tmp_path), parts=True, name="calls")
    assert Counter(tuple(r) for r in got.select(*content_columns()).collect()) == direct([r for b in batches for r in b], 24, 512)
    kept = spark.read.format("statestore").option("stateVarName", "entries").load(str(tmp_path / "turnlake-stream-calls" / "checkpoint")).select("key.thread", "user_map_value.ref")
    assert {tuple(r) for r in kept.collect()} == {("a", "5"), ("b", "3")}


def test_without_a_thread_nothing_is_matched_or_numbered(spark):
    event = lambda thread, request, e: (f"{thread or ''}{request}", request, thread, e)
    call = {"type": "response.output_item.done", "item": {"type": "function_call", "id": "f", "name": "shell", "call_id": "c1", "arguments": "{}"}}
    create = {"type": "response.create", "input": [{"type": "function_call_output", "id": "o", "call_id": "c1", "output": "done"}]}
    import json

    rows = [event(None, "ws_a", call), event(None, "ws_b", create), event("t", "ws_c", call), event("t", "ws_d", create), event("t", "ws_e", call), event("t", "ws_f", call)]
    lines = [("f", i, json.dumps({"request_id": r, "timestamp": f"2024-01-0{1 + (i > 4) * 3}T00:00:{i:02d}Z", "headers": {"thread-id": t} if t else {}, "payload": {"text": json.dumps(e)}})) for i, (_, r, t, e) in enumerate(rows)]
    f = wire.decode(spark.createDataFrame(lines, "file string, frame_seq long, raw string"))
    calls, outputs = content.tool_calls(f), content.tool_outputs(f)
    assert {r["request_id"]: r["occurrence"] for r in calls.collect()} == {"ws_a": None, "ws_c": 1, "ws_e": 2, "ws_f": 1}
    got = {r["request_id"]: (r["match"], r["origin"] and r["origin"]["request_id"]) for r in content.matched_outputs(calls, outputs).collect()}
    assert got == {"ws_b": ("none", None), "ws_d": ("exact", "ws_c")}


def test_a_row_without_a_time_costs_others_nothing(spark):
    at = lambda h: T0 + timedelta(hours=h)
    calls = [("t", 1, at(0), 1), ("u", 1, None, 11), ("v", 1, at(30), 21), ("v", 2, at(1), 22)]
    outputs = [("t", 2, None, 2), ("t", 3, at(1), 3), ("u", 9, at(99), 12), ("v", 3, at(1), 23)]
    make = lambda rows: spark.createDataFrame(rows, "thread string, o long, ts timestamp, ref long")
    got = {r["ref"]: (r["match"], r["matched_ref"]) for r in content.match_outputs(make(calls), make(outputs), ["thread"], "o", "ts").collect()}
    assert got == {2: ("exact", 1), 3: ("none", None), 12: ("exact", 11), 23: ("exact", 21)}
    again = content.match_outputs(make([*calls, ("t", 0, None, 4)]), make(outputs), ["thread"], "o", "ts").where("ref = 2").first()
    assert again["match"] == "ambiguous"
