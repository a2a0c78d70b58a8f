"""Decoding and reducing hand-made frames."""

import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import turns
from turnlake.sources import frames as wire


def line(request_id, ev, **over):
    base = {"request_id": request_id, "timestamp": "2026-01-02T03:04:05.123456Z", "headers": {"Thread-Id": "t1", "thread-id": "t2"}, "payload": {"text": ev}, "extra": {"frame_type": "text"}}
    return json.dumps(base | over)


def frames(spark, lines):
    return wire.decode(spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, frame_seq long, raw string"))


def test_payloads_headers_and_bad_lines(spark):
    ev = {"type": "response.created", "response": {"id": "r"}}
    got = frames(spark, [
        line("ws_1", json.dumps(ev)), line("ws_1", ev), line("ws_1", "﻿: note\r\nevent: x\r\ndata: {\"type\":\r\ndata: \"response.created\"}\r\n\r\n"),
        line("u", None, payload={"error": {"code": "c"}}), "{broken", "", line("", {"type": wire.DELTAS[0], "delta": "x"}, extra={"frame_type": "close", "close_code": 1000}), line("ws_2", "plain text"),
    ]).orderBy("frame_seq").collect()
    assert [r["ev_type"] for r in got] == ["response.created"] * 3 + ["error", None, None, wire.DELTAS[0], None]
    assert [r["decode_ok"] for r in got] == [True, True, True, True, False, False, True, True]
    assert got[0]["headers"] == {"thread-id": "t2"} and got[0]["family"] == "websocket" and got[3]["family"] == "http"
    assert got[6]["is_delta"] and got[6]["event"] is None and got[6]["is_transport"] and got[6]["close_code"] == 1000


def test_instances_reopen_after_a_terminal_event(spark):
    create, done = {"type": "response.create", "model": "a"}, {"type": "response.completed", "response": {"status": "completed", "model": "b", "usage": {"input_tokens": 0, "output_tokens": 3}}}
    rows = [line("x", create), line("x", done), line("x", create), line("y", create), line("y", {"type": "error", "error": {"type": "rate", "code": "q"}, "status": 500, "status_code": 429}), line("", {"type": "error", "error": {"type": "loose"}}), line("", create)]
    f = frames(spark, rows)
    got = {(r["request_id"], r["instance"]): r for r in turns.assemble(f).collect()}
    assert {k: r["status"] for k, r in got.items()} == {("x", 0): "completed", ("x", 1): "incomplete", ("y", 0): "error"}
    assert got["x", 0]["model"] == "b" and got["x", 1]["model"] == "a" and got["x", 0]["cache_ratio"] is None
    assert got["y", 0]["error_status"] == 429 and got["y", 0]["error_code"] == "q"
    assert [r["frame_seq"] for r in turns.loose(f).collect()] == [5]
    assert turns.assemble(f.where("false")).count() == 0


def test_archives_with_members_and_a_cut_tail(spark, tmp_path):
    members = [gzip.compress((line("ws_1", {"type": "response.created"}) + "\n").encode()) for _ in range(5)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "2026-01-02T03.jsonl.gz").write_bytes(b"".join(members))
    (tmp_path / "2026-01-02T04.jsonl.gz").write_bytes(members[0] + members[1][:-9])
    (tmp_path / "other.txt").write_text("no")
    lines = wire.read_archives(spark, str(tmp_path))
    counts = {r["file"]: r["count"] for r in lines.groupBy("file").count().collect()}
    assert counts["2026-01-02T03.jsonl.gz"] == 5 and counts["2026-01-02T04.jsonl.gz"] >= 1
    assert wire.decode(lines).where("decode_ok").count() >= 6


@pytest.mark.parametrize(
    ("value", "want"), [("1h30m", 5400.0), ("45s", 45.0), ("250ms", 0.25), ("90", 90.0), ("0", None), ("x", None), ("1.5m", 90.0), (None, None)]
)
def test_durations(spark, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(X.duration_seconds(F.col("v"))).first()[0] == want


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    text = "aé日😀z"
    raw = text.encode()
    for n in range(1, len(raw) + 2):
        assert one(X.byte_cut(F.lit(text), n)) == raw[:n].decode(errors="ignore")
    assert one(X.flat_text(F.try_parse_json(F.lit('[{"text":"a"},{"x":1},{"text":"b"}]')))) == "ab"
    assert one(X.flat_text(F.try_parse_json(F.lit('"s"')))) == "s"
    assert one(X.canonical_json(F.lit('{"b": 1, "a": [2]}'))) == '{"a":[2],"b":1}'
    assert one(X.balance(F.lit(" $1,234.50 "))) == 1234.5 and one(X.balance(F.lit("n/a"))) is None
    assert [one(X.id_shape(F.lit(x))) for x in ("", "ws_1", "resp_2", "0" * 8 + "-0000-0000-0000-" + "0" * 12, "abc")] == ["empty", "ws_", "resp_", "uuid", "other:len3"]
    assert [one(X.framing(F.lit(x))) for x in ("", "data: x", "{}", "[1]", "12", "hi")] == ["empty", "sse", "object", "array", "scalar", "plain"]
    assert [one(X.magnitude(F.lit(x))) for x in (0, -5, 1, 9, 10, 1000)] == [-1, -1, 0, 0, 1, 3]
    assert one(X.one_line(F.lit("  a \n b  c"), 4)) == "a b…" and one(X.head_tail(F.lit("abcdefghij"), 3, 2)) == "abc…[5 chars elided]…ij"
    assert [one(X.routing_hint(F.lit(h), F.lit("m"))) for h in ("model=m", "a;model=n", "")] == ["agree", "disagree", "absent"]
    assert one(X.redact_arguments(F.lit('{"encrypted_x":{"a":"b"},"c":"gA' + "A" * 96 + '","d":1}'))).asDict() == {"body": '{"encrypted_x":{"a":"[encrypted]"},"c":"[encrypted]","d":1}', "hidden": 2}
    assert one(X.bound_json(F.lit('{"a":"' + "x" * 50 + '"}'), 20)) == '{"truncated":true}'
    assert one(X.epoch_time(F.lit(0.0))) is None and one(F.unix_millis(X.epoch_time(F.lit(1.2345)))) == 1234


def test_encrypted_values_are_told_by_their_bytes(spark):
    import base64

    token = lambda first, n: base64.urlsafe_b64encode(bytes([first, 0x5F]) + b"x" * (n - 2)).decode()
    cases = [(token(0x80, 73), True), (token(0x80, 73).rstrip("="), True), (token(0x80, 72), False), (token(0x81, 90), False), (token(0x80, 75)[:50] + "\n" + token(0x80, 75)[50:], True), ("gA" + "A" * 95, False), ("gF8A" + "A" * 96, True), (token(0x80, 80) + "!", False)]
    rows = spark.createDataFrame([(json.dumps({"a": [{"b": v}]}),) for v, _ in cases] + [("not json gA" + "A" * 120,), (None,), ('{"k":"' + "\\u0067" + token(0x80, 90)[1:] + '"}',)], "a string")
    got = [r[0] for r in rows.select(X.hidden_arguments(F.col("a")).alias("r")).collect()]
    assert [g["hidden"] for g in got] == [int(hit) for _, hit in cases] + [0, 0, 1]
    assert got[len(cases)]["body"] == json.dumps("not json gA" + "A" * 120) and got[len(cases) + 1]["body"] is None


def test_many_header_names_cost_in_proportion_and_equal_ones_still_give_way(spark):
    names = F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("H"), i.cast("string")))
    began = time.monotonic()
    assert spark.range(1).select(F.size(X.lower_keys(F.map_from_arrays(names, names))).alias("n")).first()["n"] == 60_000
    assert time.monotonic() - began < 8  # comparing all with all takes much longer
    few = spark.sql("select map('A', '1', 'b', '2', 'a', '3') as m union all select null union all select map()")
    assert [r[0] for r in few.select(X.lower_keys(F.col("m"))).collect()] == [{"b": "2", "a": "3"}, None, {}]
