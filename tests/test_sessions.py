"""Operators on whole sessions: odd values, empty tables, and cases that the queries' data don't have."""

import json

import pytest
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import content, enrich, fanout, live, profile, threads, timing, turns
from turnlake.plans import wire as plans
from turnlake.sources import capture
from turnlake.sources import frames as wire
from turnlake.streaming import jobs, state


def frames(spark, *events, request="ws_1", **record):
    rows = []
    for i, e in enumerate(events):
        line = {"request_id": request, "timestamp": f"2024-01-01T00:00:{i:02d}Z", "payload": {"text": json.dumps(e) if isinstance(e, dict) else e}, **record}
        rows.append(("f", i, json.dumps(line)))
    return wire.decode(spark.createDataFrame(rows, "file string, frame_seq long, raw string"))


def create(*items, **more):
    return {"type": "response.create", "model": "m", "input": list(items), **more}


DONE = {"type": "response.completed", "response": {"id": "r", "status": "completed"}}


def test_an_empty_capture_gives_empty_tables(spark):
    f = wire.decode(capture.capture(spark.createDataFrame([], "conv_id long, turn long, role string, text string")))
    t = timing.complete(turns.assemble(f), timing.timings(f))
    calls, items = content.tool_calls(f), plans.items(f)
    outputs = content.matched_outputs(calls, content.tool_outputs(f))
    tables = [t, calls, items, outputs, fanout.trace(t, calls, outputs), fanout.log_lines(t, items, content.instruction_bodies(f))[0], live.digest_blocks(t, items)]
    tables += [fanout.generation_documents(t, items, content.instruction_bodies(f), content.tool_catalogues(f)), live.in_flight(t, calls, content.messages(f)), profile.capture_signature(f)]
    assert all(x.count() == 0 for x in tables)


def test_the_body_goes_before_the_header_and_null_is_absent(spark):
    meta = json.dumps({"turn_id": "T", "request_kind": "turn", "parent_thread_id": "p", "workspaces": None, "window_number": 0})
    f = frames(spark, create(client_metadata={"thread_id": "body", "x-codex-turn-metadata": meta}), DONE, headers={"Thread-Id": "head", "Session-Id": "s", "x-codex-turn-metadata": '{"request_kind":"prewarm","agent_name":"a"}', "traceparent": "00-a-b"})
    r = turns.assemble(f).first()
    assert (r["thread_id"], r["session_id"], r["turn_id"], r["request_kind"], r["parent_thread_id"], r["is_subagent"], r["agent_name"]) == ("body", "s", "T", "turn", "p", True, "a")
    assert (r["client_trace_id"], r["workspaces"], r["window_number"], r["input_tokens"], r["safety_buffering"]) == (None, None, None, None, False)
    r = turns.assemble(frames(spark, create(client_metadata={"x-codex-turn-metadata": "{broken"}), headers={"session-id": "s"})).first()
    assert (r["thread_key"], r["request_kind"], r["status"]) == ("session:s", None, "incomplete")


@pytest.mark.parametrize("value, buffered, model", [(False, False, None), (True, True, None), ({"retry_model": "x", "reasons": ["a"]}, True, "x"), (None, False, None)])
def test_safety_buffering_is_a_flag_or_an_object(spark, value, buffered, model):
    r = turns.assemble(frames(spark, create(), {**DONE, "safety_buffering": value})).first()
    assert (r["safety_buffering"], r["safety_retry_model"]) == (buffered, model)


def test_quota_families_and_zeros(spark):
    h = {"X-Codex-Primary-Used-Percent": "0", "x-codex-bengalfox-limit-name": "n", "x-base-model-inference-secondary-reset-at": "5.5", "x-my-new-primary-window-minutes": "", "x-my-new-secondary-window-minutes": "60", "other": "1"}
    df = spark.createDataFrame([(1, h), (2, None), (3, {})], "k int, h map<string,string>")
    got = {r["family"]: r for r in turns.quota_headers(df, "k", "h").collect()}
    assert set(got) == {"codex", "bengalfox", "base_model_inference", "my_new"}
    assert got["codex"]["windows"]["primary"]["used"] == 0.0 and got["bengalfox"]["limit_name"] == "n" and got["bengalfox"]["windows"] == {}
    assert got["base_model_inference"]["windows"]["secondary"]["reset_at"] == 5.5 and set(got["my_new"]["windows"]) == {"secondary"}


def test_images_are_counted_and_never_shown(spark):
    parts = [{"type": "input_image", "image_url": "data:image/png;base64," + "A" * 999}, {"type": "input_text", "text": "see"}]
    one = {"type": "message", "role": "user", "content": parts[:1]}
    other = {"type": "message", "role": "user", "content": [{"image_url": "https://x/y.png"}]}
    f = frames(spark, create(one, {"type": "message", "role": "user", "content": parts}, other, one, {"type": "message", "role": "user", "content": ""}))
    got = {(r["body"], r["images"], r["image_mime"]) for r in content.prompts(f).collect()}
    assert got == {("", 1, None), ("", 1, "image/png"), ("see", 1, "image/png")} and not any("AAAA" in str(r) for r in content.prompts(f).collect())


def test_calls_sent_twice_count_once_and_a_reused_id_is_another(spark):
    call = {"type": "response.output_item.done", "item": {"type": "function_call", "name": "f", "call_id": "c", "arguments": '{"a":{"encrypted_key":["x"]}}'}}
    custom = {"type": "response.output_item.done", "item": {"type": "custom_tool_call", "name": "g", "input": "raw"}}
    made = lambda i: {"type": "response.created", "response": {"id": i}}
    f = frames(spark, create(), made("r1"), call, call, custom, DONE, made("r2"), call, headers={"thread-id": "t"})
    got = [(r["name"], r["instance"], r["occurrence"], r["hidden"], r["input"]) for r in content.tool_calls(f).orderBy("frame_seq").collect()]
    hidden = '{"a":{"encrypted_key":["[encrypted]"]}}'
    assert got == [("f", 0, 1, 1, hidden), ("g", 0, None, 0, "raw"), ("f", 1, 2, 1, hidden)]


def test_text_is_cut_so_that_the_line_fits(spark):
    texts = ["short", "x" * 300, '"' * 200, "\n\\" * 100, "é日😀" * 60, "\x01" * 90, "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for most in (60, 61, 62, 63, 64, 65, 66, 120):
        for r in df.select("i", "t", fanout.fit_text({"i": F.col("i"), "text": F.col("t")}, "text", most).alias("j")).collect():
            assert len(r["j"].encode()) <= most
            got = json.loads(r["j"])
            if "full_bytes" in got:
                assert r["t"].startswith(got["text"]) and got["full_bytes"] == len(r["t"].encode())
                longer = dict(got, text=r["t"][: len(got["text"]) + 1])
                assert len(json.dumps(longer, separators=(",", ":"), ensure_ascii=False).encode()) > most
            else:
                assert got.get("text") == r["t"]
    assert df.where("i = 1").select(fanout.fit_text({"text": F.col("t")}, "text", 5)).first()[0] is None


def test_chains_stars_and_cycles_climb(spark):
    chain = [(i, i - 1 if i else None) for i in range(70)]
    star = [(100 + i, 100) for i in range(50)]
    odd = [(200, 200), (201, 999), (300, 301), (301, 302), (302, 300), (303, 300), (None, 1)]
    df = spark.createDataFrame(chain + star + odd, "node long, parent long")
    got = {r["node"]: r for r in threads.climb(df, "node", "parent", F.col("node").isin(40, 110)).collect()}
    assert all((got[i]["root"], got[i]["depth"], got[i]["descendants"]) == (0, i, 69 - i) for i in range(70))
    assert (got[100]["root"], got[100]["descendants"], got[149]["depth"]) == (100, 49, 1) and got[201]["root"] == 201
    assert all(got[i]["root"] is None and got[i]["depth"] is None for i in (300, 301, 302, 303))
    assert {i for i, r in got.items() if r["marked"]} == {*range(41), 100, 110}


def test_values_and_embedded_documents(spark):
    docs = [("k", json.dumps({"id": f"v{i}", "doc": '{"a": 1}' if i % 2 else "plain"})) for i in range(500)]
    walked = profile.paths(spark.createDataFrame(docs, "kind string, doc string"), "kind", "doc", embedded=frozenset({"doc"}))
    induced = {(r["path"], r["json_type"]): r["n"] for r in profile.induce(walked).collect()}
    assert induced["doc{}.a", "number"] == 250 and induced["doc", "string"] == 500
    counts = profile.value_counts(walked, 20).where("path = 'id'").collect()
    assert len(counts) == 20 and all(r["capped"] for r in counts)
    assert {r["capped"] for r in profile.induce(walked, 2).collect()} == {True}


def test_call_error_and_activity(spark):
    df = spark.createDataFrame([("t", "c", "m"), ("t", "", None), (None, "c", "m")], "a string, b string, c string")
    got = [r[0] for r in df.select(fanout.call_error(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["t (c): m", "t", None]
    names = spark.createDataFrame([("/root/a",), ("/root/a/",), ("b",), (None,)], "p string").select(live.task_name(F.col("p"))).collect()
    assert [r[0] for r in names] == ["a", "/root/a/", "b", None]


def test_logs_answer_once_and_deleted_ones_never(spark):
    t = turns.assemble(frames(spark, create(service_tier="fast"), {"type": "response.created", "response": {"id": "r"}}, DONE))
    empty = {c: None for c in enrich.LOG_COLUMNS.values()}
    logs = [dict(empty, request_id="r", archive_id=None, id=1, deleted=False, cost_usd=1.0, actual_tier="fast"), dict(empty, request_id="r", archive_id=None, id=2, deleted=True, cost_usd=9.0)]
    numbers = {"cost_usd", "queue_wait_ms", "gate_wait_ms", "bridge_wait_ms", "latency_ms", "first_token_ms"}
    whole = {"upstream_status", "retries"}
    schema = "request_id string, archive_id string, id long, deleted boolean, " + ", ".join(f"{c} {'double' if c in numbers else 'int' if c in whole else 'string'}" for c in enrich.LOG_COLUMNS.values())
    rows = spark.createDataFrame([tuple(r[k] for k in ["request_id", "archive_id", "id", "deleted", *enrich.LOG_COLUMNS.values()]) for r in logs], schema)
    twice = t.unionByName(t.withColumn("instance", F.lit(1).cast("long")))
    got = sorted(((r["instance"], r["cost_usd"], r["tier_outcome"], r["outcome"]) for r in enrich.attach_log(twice, rows).collect()), key=str)
    assert got == [(0, 1.0, "granted", "hit"), (1, None, "granted", "hit")]


def test_streamed_series_reset_and_expire(spark, tmp_path):
    batches = [[("a", 1, 0, 1.0, 5.0), ("b", 1, 0, 1.0, 7.0)], [("a", 2, 60, 2.0, 9.0)], [("a", 3, 120, 1.0, 4.0), ("c", 1, 10 * 86_400, 1.0, 1.0)], [("b", 2, 10 * 86_400, 2.0, 8.0)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "s string, o long, t long, calls double, x double").selectExpr("s", "o", "timestamp_seconds(1700000000 + t) as ts", "calls", "x")
        df.coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = jobs.drain(jobs.series_deltas(stream, ["s"], "o", "calls", ["x"], "ts"), str(tmp_path))
    got = {(r["s"], r["o"]): (r["reset"], r["baseline_reset"], r["delta_x"]) for r in out.collect()}
    assert got == {("a", 1): (True, True, 5.0), ("b", 1): (True, True, 7.0), ("a", 2): (False, False, 4.0), ("a", 3): (True, False, 4.0), ("c", 1): (True, True, 1.0), ("b", 2): (True, True, 8.0)}


def test_late_rows_never_rewind_the_clock(spark, tmp_path):
    for i, seconds in enumerate([[0, 10, 4000], [4050], [20, 4100], [9000]]):  # the 20 comes after its window was closed
        spark.createDataFrame([(s,) for s in seconds], "s long").selectExpr("timestamp_seconds(1700006400 + s) as ts").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("ts timestamp").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.drain(jobs.tumbling_counts(stream, "ts", "1 hour", [], "5 minutes"), str(tmp_path)).select(F.unix_seconds("step").alias("s"), "n").collect()
    assert {(r["s"] - 1700006400) // 3600: r["n"] for r in got} == {0: 2, 1: 3}


def test_whole_characters(spark):
    text = "aé日😀"
    df = spark.range(1)
    for n in range(len(text.encode()) + 1):
        want = text.encode()[:n].decode(errors="ignore")
        assert df.select(X.byte_cut(F.lit(text), n)).first()[0] == want


def test_attributes_keep_to_their_classes(spark):
    from turnlake.operators import metrics

    df = spark.createDataFrame([("m", "r1", 0, {"x.a": "1", "x_a": "2", "odd": "3", "model": "n"})], "model string, request_id string, text_deltas int, extra map<string,string>")
    r = df.select(
        metrics.bounded_attributes(df.columns).alias("b"), metrics.log_metadata(df.columns).alias("l"), metrics.stream_labels(df.columns, F.lit("turn")).alias("s"),
        metrics.guarded(metrics.bounded_attributes(df.columns), F.col("extra"), ("x.a", "model")).alias("g"), metrics.sanitised(F.col("extra")).alias("n"), metrics.guarded(metrics.attributes(a=F.lit("1")), F.lit(None).cast("map<string,string>"), ()).alias("z"),
    ).first()
    assert r["b"] == {"model": "m", "provider": "openai", "operation": "generateText"} and r["l"]["request_id"] == "r1" and "model" not in r["l"]
    assert list(r["s"].items()) == [("model", "m"), ("record_type", "turn")] and r["g"]["attrs"]["model"] == "n" and r["g"]["rejected"] == 2
    assert r["n"] == {"x_a": "1", "odd": "3", "model": "n"} and r["z"]["attrs"] == {"a": "1"} and r["z"]["rejected"] == 0
    with pytest.raises(ValueError):
        metrics.stream_labels(df.columns, F.lit("turn"), ("request_id",))


def test_idle_unknown_and_recorded(spark, tmp_path):
    from turnlake.functions import columns
    from turnlake.operators import reports
    from turnlake.sources import tables

    f = frames(spark, create(), {"type": "response.odd"}).unionByName(frames(spark, create(), request="ws_2").withColumn("ts", F.col("ts") + F.expr("interval 2 hours")))
    got = {r["request_id"]: r["idle"] for r in turns.close_idle(turns.assemble(f)).collect()}
    assert got == {"ws_1": True, "ws_2": False}
    assert [tuple(r) for r in wire.unknown_events(f).collect()] == [("response.odd", 1)]
    for _ in range(2):  # a retry of a batch changes nothing
        tables.write_batch({"turns": turns.assemble(f), "frames": f.select("file", "frame_seq")}, str(tmp_path), 3)
    assert spark.read.parquet(str(tmp_path / "turns")).count() == 2 and spark.read.parquet(str(tmp_path / "frames")).count() == 3
    for run in ("a", "b"):
        profile.record_run(spark.createDataFrame([("new", run)], "severity string, what string"), run, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).groupBy("run").count().count() == 2
    names = spark.createDataFrame([("/root/a", "ask", "p"), (None, "ask", "p"), (None, None, "p"), (None, None, None)], "t string, a string, p string")
    assert [r[0] for r in names.select(reports.display_name(F.col("t"), F.col("a"), F.col("p"))).collect()] == ["a", "ask", "subagent", "session"]
    assert [r[0] for r in spark.createDataFrame([("acct_1",), ("acct",)], "a string").select(columns.bare_account(F.col("a"))).collect()] == ["acct", "acct"]


def test_lookup_decodes_whole_requests(spark):
    lines = [("f", 0, '{"request_id":"a","payload":{"text":"{\\"type\\":\\"response.create\\"}"}}'), ("f", 1, '{"request_id":"b","payload":{"text":"needle"}}'), ("f", 2, '{"request_id":"a","payload":{"text":"needle"}}'), ("f", 3, '{"payload":{"text":"needle"}}'), ("f", 4, "{broken needle")]
    got = wire.lookup(spark.createDataFrame(lines, "file string, frame_seq long, raw string"), F.col("raw").contains("needle"))
    assert sorted(r["frame_seq"] for r in got.collect()) == [0, 1, 2]


def test_responses_leave_the_stream_whole(spark, tmp_path):
    line = lambda rid, s, e: json.dumps({"request_id": rid, "timestamp": f"2024-01-01T{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}Z", "payload": {"text": json.dumps(e)}})
    batches = [
        [("f1", 0, line("a", 0, create())), ("f1", 1, line("b", 1, create())), ("f1", 2, line("", 2, {"type": "error"}))],
        [("f2", 0, line("a", 60, DONE)), ("f2", 1, line("a", 61, create()))],  # the same request again
        [("f3", 0, line("z", 3 * 3600, create()))], [("f4", 0, line("z", 3 * 3600 + 1, DONE))],
    ]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "file string, frame_seq long, raw string")
        df.coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.drain(state.closed(wire.decode(stream)), str(tmp_path), parts=True, each=lambda b: turns.assemble(wire.decode(b)))
    rows = sorted((r["request_id"], r["first_seq"]["file"], r["frames"], r["status"]) for r in got.collect())
    assert rows == [("a", "f1", 2, "completed"), ("a", "f2", 1, "incomplete"), ("b", "f1", 1, "incomplete"), ("z", "f3", 2, "completed")]


def test_transport_frames_tell_why_a_connection_ended(spark):
    from turnlake.operators import registry

    close = {"extra": {"frame_type": "close", "close_code": 1012}}
    f = frames(spark, "going away", "second", **close).unionByName(frames(spark, create(), request="ws_2"))
    r = {x["request_id"]: x for x in turns.assemble(f).collect()}
    assert (r["ws_1"]["transport_event"], r["ws_1"]["close_code"], r["ws_1"]["frame_errors"], r["ws_2"]["transport_event"]) == ("going away", 1012, 0, None)
    loose = turns.assemble(turns.loose(frames(spark, "bye", request="", **close)).withColumn("request_id", F.lit("frame-0")))
    assert loose.first()["transport_event"] == "bye"
    only = [m for m in registry.METRICS if m.name == "transport_events"]
    points = registry.points(turns.assemble(f), "last_ts", ["first_seq"], only).collect()
    assert [(p["metric"], p["attrs"], p["value"]) for p in points] == [("transport_events", {"close_code": "1012"}, 1.0)]
