"""Frames that are sorted once for all operators, and responses that leave a stream of large batches."""

import json

from test_sessions import DONE, create, frames

from turnlake.operators import content, turns
from turnlake.sources import frames as wire
from turnlake.sources.tables import checkpointed
from turnlake.streaming import jobs


def test_owned_frames_are_sorted_once(spark):
    call = {"type": "response.output_item.done", "item": {"type": "function_call", "name": "f", "call_id": "c", "arguments": "{}"}}
    said = {"type": "response.output_item.done", "item": {"type": "message", "content": [{"type": "output_text", "text": "hi"}]}}
    asked = create(input=[{"type": "message", "role": "user", "content": "q"}, {"type": "function_call_output", "call_id": "c", "output": "r"}], client_metadata={"thread_id": "t1"})
    made = {"type": "response.created", "response": {"id": "r1"}}
    f = frames(spark, asked, made, call, DONE, said, call, call)  # the next response of the request names neither a thread nor an id
    table = checkpointed(content.owned(f))
    got = sorted((r["frame_seq"], r["instance"], r["thread_id"], r["response"]) for r in table.where("ev_type like '%item.done'").collect())
    assert [(i, response) for _, i, _, response in got] == [(0, "r1"), (1, "ws_1"), (1, "ws_1"), (1, "ws_1")]
    assert got[0][2] == "t1" and {t for _, _, t, _ in got[1:]} != {"t1"}
    given = checkpointed(content.input_items(table))
    for op, src in ((turns.assemble, table), (content.tool_calls, table), (content.messages, table), (content.prompts, given), (content.tool_outputs, given)):
        own, shared = op(f), op(src).select(*op(f).columns)
        assert sorted(map(str, own.collect())) == sorted(map(str, shared.collect())) and own.count() > 0
    for df in (turns.assemble(table), content.messages(table), content.prompts(given)):
        assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_responses_leave_large_batches_whole(spark, tmp_path):
    line = lambda rid, s, e: json.dumps({"request_id": rid, "timestamp": f"2024-01-01T{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}Z", "payload": {"text": json.dumps(e)}})
    batches = [
        [("f1", 0, line("a", 0, create())), ("f1", 1, line("b", 1, create())), ("f1", 2, line("", 2, {"type": "error"}))],
        [("f2", 0, line("a", 60, DONE)), ("f2", 1, line("a", 61, create()))],  # the same request again
        [("f3", 0, line("z", 3 * 3600, create()))], [("f4", 0, line("b", 5, DONE)), ("f4", 1, line("z", 3 * 3600 + 1, DONE)), ("f4", 2, line("y", 3 * 3600 + 2, create()))],  # b's end is late
    ]
    schema = "file string, frame_seq long, raw string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.close_stream(wire.decode(stream).drop("raw"), turns.assemble, str(tmp_path), name="x")
    rows = sorted((r["request_id"], r["first_seq"]["file"], r["frames"], r["status"]) for r in got.collect())
    assert rows == [("a", "f1", 2, "completed"), ("a", "f2", 1, "incomplete"), ("b", "f1", 1, "incomplete"), ("z", "f3", 2, "completed")]  # y is open still
    loose = jobs.close_stream(wire.decode(stream).drop("raw"), lambda f: f.where("coalesce(request_id, '') = ''").select("file", "ev_type"), str(tmp_path), name="y")
    assert [tuple(r) for r in loose.collect()] == [("f1", "error")]
