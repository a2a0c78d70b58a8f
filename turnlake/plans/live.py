"""Registered queries on what responses become: log lines, spans, generation records, live threads, surveys, alerts and digests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.operators import content, enrich, fanout, live, metrics, nesting, profile, reports, threads, timing, turns
from turnlake.plans.queries import EVENTS, PATHS, oracle_sql, query
from turnlake.plans.wire import CAPTURE, SHOWN, completed, items, sessions, timed
from turnlake.sources import capture, index, tail
from turnlake.sources import frames as wire
from turnlake.sources.tables import checkpointed, committed, land, shared_dir, table
from turnlake.streaming import jobs

_END = "case when failed then ms + 1100 else ms + 5500 end"


@query(CAPTURE + SHOWN + f""", i as (select c % 3 as g, min(c * 1000000 + t) as o from a group by 1),
u as (select 'turn' as record_type, request_id, {_END} as ts from a union all select 'error', request_id, ms + 1100 from a where failed union all select 'message', request_id, {_END} from a union all select 'tool_call', request_id, {_END} from a
  union all select 'tool_output', request_id, ms from a where back1 is not null union all select 'agent_message', 'ws_' || c || '_' || min(t), min(ms) from a where sub group by c
  union all select 'instructions', request_id, ms from i join a on c * 1000000 + t = o union all select 'prompt', request_id, ms from shown join a using (request_id))
select record_type, request_id, count(*) as n, min(ts) as ts from u group by 1, 2""")
def log_lines(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    t = checkpointed(turns.assemble(f))  # each type of record of a turn reads it, and so do the times of its content
    lines, _ = fanout.log_lines(t, items(f), content.instruction_bodies(f))
    return lines.groupBy("record_type", "request_id").agg(F.count("*").alias("n"), F.min(F.unix_millis("ts")).alias("ts"))


_Z = "|| chr(0) ||"
_TRACE, _SPAN = f"substr(sha256('thread' {_Z} thread_id), 1, 32)", lambda *parts: f"substr(sha256({f' {_Z} '.join(parts)}), 33, 16)"
_RESP, _ROOT = _SPAN("'response'", "request_id", "'0'"), _SPAN("'turn'", "thread_id", "'turn_' || c || '_' || (t // 2)")
_R0 = "case when failed then ms else ms + 250 end"
_CALL = lambda t: _SPAN("'tool'", "thread_id", f"'call_' || c || '_' || {t}", "'1'")


@query(CAPTURE + f""", p as (select *, lag(calls) over w as prev, lag(ms) over w as prev_ms from a window w as (partition by c, kind order by t)),
r as (select *, prev is null or ms - (prev_ms + 1000) > 1800000 or calls <= prev as reset from p), q as (select *, case when reset then calls else calls - prev end as fresh from r),
s as (select {_TRACE} as trace_id, {_ROOT} as span_id, null as parent_span_id, 'turn' as name, min(ms - 1000) as "start", max({_END}) as "end", case when bool_or(failed) then 'error' else 'ok' end as state, 1 as links from q group by all
  union all select {_TRACE}, {_RESP}, {_ROOT}, 'streamText ' || case when not failed and t % 8 = 0 then 'm1b' else 'm1' end, {_R0}, {_END}, case when failed then 'error' else 'ok' end, 0 from q
  union all select {_TRACE}, {_SPAN("'phase'", "request_id", "'0'", "'pre_inference'")}, {_RESP}, 'critical_path.pre_inference', {_R0}, {_R0} + 2, case when failed then 'error' else 'ok' end, 0 from q where t % 2 = 0
  union all select {_TRACE}, {_SPAN("'phase'", "request_id", "'0'", "'engine_wall'")}, {_RESP}, 'critical_path.engine_wall', {_R0} + 2, {_R0} + 2 + t * 10, case when failed then 'error' else 'ok' end, 0 from q where t % 2 = 0 and t > 0
  union all select {_TRACE}, {_SPAN("'phase'", "request_id", "'0'", "'sampling_and_stream'")}, {_RESP}, 'critical_path.sampling_and_stream', {_R0} + 2 + t * 10, {_R0} + 2 + t * 14, case when failed then 'error' else 'ok' end, 0 from q where t % 2 = 0 and t > 0
  union all select {_TRACE}, {_CALL("t")}, {_RESP}, 'invoke_agent /root/task' || t, {_R0}, case when fresh = 1 then {_R0} + calls else {_END} end, case when failed then 'error' else 'ok' end, 0 from q
  union all select {_TRACE}, {_SPAN("'tool_result'", "request_id", "'0'", "'call_' || c || '_' || back1", "pos::varchar")}, {_RESP}, 'tool_result', {_R0}, {_END}, case when failed then 'error' else 'ok' end, 1
    from (select q.*, (select least(count(*), 3) from c where c.c = q.c and c.t < q.t) + (back2 is not null)::int as pos from q where back1 is not null))
select * from s""")
def span_forest(spark: SparkSession, d: str) -> DataFrame:
    return _traces(spark, d).select("trace_id", "span_id", "parent_span_id", "name", F.unix_millis("start").alias("start"), F.unix_millis("end").alias("end"), "state", F.size("links").alias("links"))


def _traces(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    t, calls = checkpointed(timed(f)), checkpointed(content.tool_calls(f))  # each kind of span reads them
    return fanout.trace(t, calls, content.matched_outputs(calls, content.tool_outputs(f)))


# The same spans walked from their roots, parents first.
_WALK = oracle_sql()["span_forest"].replace("with ", "with recursive ", 1).removesuffix("select * from s") + """, walk as (
  select *, 0 as depth, [("start", span_id)] as way, [span_id] as line from s where parent_span_id is null
  union all select s.*, t.depth + 1, list_append(t.way, (s."start", s.span_id)), list_append(t.line, s.span_id) from s join walk t on s.trace_id = t.trace_id and s.parent_span_id = t.span_id),
placed as (select *, row_number() over (partition by trace_id order by way) - 1 as enter from walk)
"""


@query(_WALK + """, ends as (select a.trace_id, a.span_id, max(b.enter) as leave from placed a join placed b on a.trace_id = b.trace_id and list_contains(b.line, a.span_id) group by all)
select trace_id, span_id, parent_span_id as parent, depth, enter, leave from placed join ends using (trace_id, span_id)""")
def span_intervals(spark: SparkSession, d: str) -> DataFrame:
    return nesting.intervals(_traces(spark, d)).select("trace_id", "span_id", "parent", "depth", "enter", "leave")


@query(_WALK + """, pairs as (select a.trace_id, a.span_id as upper, a.name as upper_name, a.state, a.depth as upper_depth, b.span_id, b.name, b.depth from placed a join placed b on a.trace_id = b.trace_id and a.span_id <> b.span_id and list_contains(b.line, a.span_id))
select 'under' as relation, span_id, arg_min(upper, upper_depth) as other, max(depth - upper_depth)::bigint as n from pairs where upper_name = 'turn' and state = 'error' and starts_with(name, 'invoke_agent') group by 2
union all select 'over', upper, null, count(*) from pairs where starts_with(upper_name, 'streamText') and starts_with(name, 'critical_path.') group by 2
union all select 'beside', a.span_id, null, count(*) from placed a join placed b on a.trace_id = b.trace_id and a.parent_span_id = b.parent_span_id and a.span_id <> b.span_id where a.name = 'tool_result' and (b.name = 'tool_result' or starts_with(b.name, 'critical_path.')) group by 2""")
def span_structure(spark: SparkSession, d: str) -> DataFrame:
    """Calls under failed turns, responses over phases, and results beside phases or other results."""
    n = checkpointed(nesting.intervals(_traces(spark, d)))
    name, none = F.col("name"), F.lit(None).cast("string").alias("other")
    calls, phases, result = name.startswith("invoke_agent"), name.startswith("critical_path."), name == "tool_result"
    failed = nesting.under(n, (name == "turn") & (F.col("state") == "error"), calls).select(F.lit("under").alias("relation"), "span_id", F.col("ancestor").alias("other"), F.col("levels").cast("long").alias("n"))
    timed = nesting.over(n, name.startswith("streamText"), phases).select(F.lit("over").alias("relation"), "span_id", none, "n")
    return failed.unionByName(timed).unionByName(nesting.beside(n, result, result | phases).select(F.lit("beside").alias("relation"), "span_id", none, "n"))


@query(CAPTURE + f""", u as (select distinct thread_id, c, t // 2 as turn, 'connection' as kind, md5(c::varchar) as target_trace, '00f067aa0ba902b7' as target from a),
parent as (select distinct c, thread_id as own, 'conv-' || par as thread_id, par from a where sub),
links as (select {_TRACE} as trace_id, kind, target_trace, target from u
  union all select {_TRACE.replace("thread_id", "u.thread_id")}, 'spawning_turn', {_TRACE.replace("thread_id", "p.thread_id")}, {_SPAN("'turn'", "p.thread_id", "'turn_' || par || '_0'")} from u join parent p on p.c = u.c and p.own = u.thread_id
  union all select {_TRACE}, 'origin_tool_call', {_TRACE}, {_CALL("back1")} from a where back1 is not null)
select *, count(*) as n from links group by all""")
def span_links(spark: SparkSession, d: str) -> DataFrame:
    """What spans link to: a turn to its client's connection and to the first turn of the thread that spawned it, a result to the call it answers."""
    f = checkpointed(sessions(spark, d))
    calls = content.tool_calls(f)
    first = F.concat(F.lit("turn_"), F.substring_index("parent_thread_id", "-", -1), F.lit("_0"))
    spans = fanout.trace(turns.assemble(f).withColumn("parent_turn_id", first), calls, content.matched_outputs(calls, content.tool_outputs(f)))
    linked = spans.select("trace_id", F.explode("links").alias("l")).select("trace_id", "l.kind", F.col("l.trace_id").alias("target_trace"), F.col("l.span_id").alias("target"))
    return linked.groupBy(*linked.columns).agg(F.count("*").alias("n"))


@query(CAPTURE + f"""select {_RESP} as span_id, 'model=' || case when not failed and t % 8 = 0 then 'm1b' else 'm1' end || ',operation=streamText,provider=openai,request_kind=' || kind || ',response_id=' || response_id || ',status=' || case when failed then 'error' else 'completed,temperature=1.0' end
  || ',thread_id=' || thread_id || case when failed then '' else ',top_p=0.98' end || ',turn_id=turn_' || c || '_' || (t // 2) as attrs, 0::bigint as elsewhere from a""")
def span_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of the spans of responses, and how many other spans have one that only a response has."""
    spans = _traces(spark, d).select("span_id", "attrs", F.col("name").rlike("^(stream|generate)Text").alias("_response"))
    own = F.array(F.lit("temperature"), F.lit("top_p"), F.lit("operation"), F.lit("provider"))
    elsewhere = spans.where(~F.col("_response") & F.arrays_overlap(F.map_keys("attrs"), own)).agg(F.count("*").alias("elsewhere"))
    return spans.where("_response").select("span_id", metrics.stable(F.col("attrs")).alias("attrs")).crossJoin(F.broadcast(elsewhere))  # one row


@query(CAPTURE + """select 'streamText ' || case when t % 8 = 0 then 'm1b' else 'm1' end as name, count(*) as n from a where not failed and t > 2 group by 1""")
def span_search(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    calls = checkpointed(content.tool_calls(f))
    late = checkpointed(timed(f)).where("window_number > 2")
    found = fanout.find_spans(fanout.trace(late, calls, content.matched_outputs(calls, content.tool_outputs(f))), pattern="streamText .*", state="ok", longer_ms=5000)
    return found.groupBy("name").agg(F.count("*").alias("n"))


@query(CAPTURE + SHOWN + """, n as (select request_id, count(*) filter (role in ('user', 'assistant')) as n from shown group by 1),
k as (select *, '[{"description":"runs","name":"shell","strict":true,"type":"function"},{"description":"","name":"t' || (c % 4) || '","strict":false,"type":"custom"}]' as tools from a)
select request_id, 'be ' || (c % 3) as system_prompt, (coalesce(n, 0) + (back1 is not null)::int)::int as inputs, 2 as outputs, 'shell,t' || (c % 4) as tools, not failed as has_usage,
  substr(sha256(substr(sha256('be ' || (c % 3)), 1, 16) || chr(0) || substr(sha256(tools), 1, 16)), 1, 16) as version, case when failed then 'usage_limit: used up ' || c end as call_error,
  case when failed then 'error' else 'stop' end as stop_reason, text as answer from k left join n using (request_id)""")
def generation_documents(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    g = fanout.generation_documents(turns.assemble(f), items(f), content.instruction_bodies(f), content.tool_catalogues(f))
    n = lambda c: F.coalesce(F.size(F.coalesce(c, F.array().cast("array<struct<ordinal:int,role:string,part:string,tool:string,call_id:string,text:string>>"))), F.lit(0))
    said = F.get(F.filter("output", lambda x: x["part"] == "message"), F.lit(0))["text"]
    return g.select("request_id", "system_prompt", n("input").alias("inputs"), n("output").alias("outputs"), F.array_join("tools", ",").alias("tools"), F.col("usage").isNotNull().alias("has_usage"), "version", "call_error", "stop_reason", said.alias("answer"))


def _shown(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    f = checkpointed(sessions(spark, d))
    t, calls, given = [checkpointed(x) for x in (turns.assemble(f), content.tool_calls(f), content.input_items(f))]
    return t, calls, content.messages(f), content.prompts(given), content.agent_messages(given)


_LINE = "trim(regexp_replace({}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


@query(CAPTURE + SHOWN + f""", k as (select 'conv-' || c as thread_key, max_by({_LINE.format('text')}, t * 10000 + m) as ask from shown where role = 'user' and length(text) <= 2000 group by 1),
x as (select thread_id as thread_key, c, sub, count(*) as turns, count(*) filter (failed) as errors, sum(size + 10) filter (not failed)::bigint as input_tokens, min(ms) as first_seen, max(ms) + 1100 as last_seen,
  max_by(text, t) filter (text <> '') as latest, max_by(failed, t) as f, max(t) as mt, string_agg('task' || t, ',' order by t) as tasks from a where c % 13 <> 12 group by 1, 2, 3)
select thread_key, turns, errors, 0 as running, input_tokens, first_seen, last_seen, case when sub then 'conv-' || (c // 3) end as parent_thread_id, tasks,
  case when length({_LINE.format('latest')}) > 200 then substr({_LINE.format('latest')}, 1, 199) || '…' else {_LINE.format('latest')} end as latest,
  case when f then 'error usage_limit' else 'shell: ' || substr('{{"cmd":"ls ' || mt || '","secret_encrypted":"[encrypted]","task_name":"/root/task' || mt || '","model":"m2","reasoning_effort":"low"}}', 1, 79) || '…' end as activity,
  case when sub then 'a' || (c % 3) when ask is null or ask = '' then 'session' when length(ask) > 200 then substr(ask, 1, 199) || '…' else ask end as name from x left join k using (thread_key)""")
def live_threads(spark: SparkSession, d: str) -> DataFrame:
    t = live.thread_table(*_shown(spark, d))
    return t.select(
        "thread_key", "turns", "errors", F.col("running").cast("int").alias("running"), "input_tokens", F.unix_millis("first_seen").alias("first_seen"), F.unix_millis("last_seen").alias("last_seen"), "parent_thread_id",
        F.array_join("tasks", ",").alias("tasks"), "latest", "activity", "name",
    )


@query(CAPTURE + """, o as (select * from a where (c + t) % 4 = 1), m as (select max(case when (c + t) % 4 = 1 then ms + 1000 else ms + 1100 end) as now from a)
select request_id, thread_id, 'shell' as last_tool, nullif(text, '') as last_message, 'task' || t as spawned_task, now - (ms + 1000) as quiet_ms, now - (ms + 1000) > 7200000 as stalled from o, m where c % 13 <> 12""")
def in_flight(spark: SparkSession, d: str) -> DataFrame:
    f = sessions(spark, d, raw=True).drop("raw")
    c, t = F.expr("frame_seq div 1000000"), F.expr("frame_seq % 1000000 div 100")
    f = checkpointed(content.owned(f.where(((c + t) % 4 != 1) | (F.col("frame_seq") % 100 < 11))))  # some never end
    out = live.in_flight(turns.assemble(f), content.tool_calls(f), content.messages(f), "2 hours")
    return out.select("request_id", "thread_id", "last_tool", "last_message", "spawned_task", "quiet_ms", "stalled")


@query(CAPTURE + """select ev_type, sum(n)::bigint as frames, ev_type <> 'response.odd' as handled from (
  select unnest(['response.create', 'response.created', 'response.in_progress', 'response.output_text.delta', 'response.output_item.done', 'response.output_item.done', 'response.output_item.done', 'codex.rate_limits',
    'codex.response.metadata', 'responsesapi.websocket_timing', case when failed then 'error' else 'response.completed' end, case when t % 3 = 0 then 'response.output_item.done' end]) as ev_type, 1 as n from a
  union all select 'response.odd', count(*) from conversations where role = 'user') where ev_type is not null group by 1 having sum(n) > 0""")
def capture_survey(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    odd = c.where("role = 'user'").select(F.lit("x").alias("file"), F.col("turn").cast("long").alias("frame_seq"), F.lit('{"request_id":"","payload":{"text":"{\\"type\\":\\"response.odd\\"}"}}').alias("raw"))
    f = wire.decode(capture.capture(c).unionByName(odd))
    return live.event_survey(f, wire.KNOWN).select("ev_type", "frames", "handled")


@query(CAPTURE + """select count(*) as responses, 0::bigint as incomplete, count(*) filter (failed) as errors, count(*) filter (sub) as subagent, count(distinct thread_id) as threads, count(distinct c || '_' || (t // 2)) as logical_turns from a""")
def response_survey(spark: SparkSession, d: str) -> DataFrame:
    return live.response_survey(completed(spark, d))


@query(CAPTURE + """select (ms + 1100) // 3600000 * 3600 as step, case when sub then 'subagent' else 'user' end as thread_source, kind as request_kind, case when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model,
  count(*) / 3600.0::double as turns, count(*) / 3600.0::double as spawns from a group by all""")
def spawn_rates(spark: SparkSession, d: str) -> DataFrame:
    t, calls, *_ = _shown(spark, d)
    return live.spawn_rates(t, calls, "1 hour", 3600).withColumn("step", F.unix_seconds("step"))


@query(CAPTURE + """select request_id, case when failed then 'failed' else 'ok' end as wire, case when (c + t) % 11 > 0 then 'ok' end as proxy, failed and (c + t) % 11 > 0 as disagree from a""")
def verdicts(spark: SparkSession, d: str) -> DataFrame:
    t = enrich.attach_log(turns.assemble(sessions(spark, d)), capture.request_logs(table(spark, d, "conversations")))
    return live.verdicts(t).select("request_id", "wire", "proxy", "disagree")


@query(CAPTURE + """, s as (select 'acct_' || (c % 5) as subject, (ms + 1100) // 300000 * 300 as step, max(t % 100) as used from a group by 1, 2), e as (select (ms + 1100) // 300000 * 300 as step, count(*) filter (failed) / 300.0 as rate from a group by 1),
h as (select subject, step, step // 300 - row_number() over (partition by subject order by step) as i from s where used > 3), k as (select step, step // 300 - row_number() over (order by step) as i from e where rate > 0.003)
select 'limit_high' as alert, subject, min(step) as begin, max(step) as last, count(*) as steps from h group by subject, i having count(*) >= 2
union all select 'errors_high', '', min(step), max(step), count(*) from k group by i""")
def alert_rules(spark: SparkSession, d: str) -> DataFrame:
    rules = {"limit_high": ("limit_used", 3.0, 2), "errors_high": ("error_rate", 0.003, 1)}
    out = live.alerts(live.watched(turns.assemble(sessions(spark, d))), rules=live.ALERTS | rules)
    return out.withColumns({c: F.unix_seconds(c) for c in ("begin", "last")})


_RULES = {"rate_limit_headroom": ("click", "max(value)", 90, 2), "breaking_drift": ("purchase", "max(value) - 60", 0, 1), "error_rate": ("error", "count(*)::double", 0.5, 2), "ingest_lag": ("view", "max(value) * 4", 300, 1)}


@query("""with e as (select *, floor(epoch(ts))::bigint // 300 * 300 as step, (user_id % 2)::varchar as subject from events),
r as (""" + " union all ".join(f"select '{a}' as alert, step, case when '{a}' = 'error_rate' then '' else subject end as subject, {v} as v, {above} as above, {hold} as hold from e where event_type = '{k}' group by all" for a, (k, v, above, hold) in _RULES.items()) + """
  union all select a, s * 300, subject, count(*), 0, 1 from (select case event_type when 'error' then 'log_rejections' else 'connection_limit' end as a, step // 300 + unnest([0, 1, 2]) as s, subject, event_id from e where value > 90 and user_id < 12) group by 1, 2, 3),
h as (select *, step // 300 - row_number() over (partition by alert, subject order by step) as i from r where v > above)
select alert, subject, min(step) as begin, max(step) as last, count(*) as steps from h group by alert, subject, i, hold having count(*) >= hold""")
def alert_thresholds(spark: SparkSession, d: str) -> DataFrame:
    """The built-in rules over readings made of events, so that each of them fires."""
    e = table(spark, d, "events").withColumns({"ts": F.col("ts").cast("timestamp"), "subject": (F.col("user_id") % 2).cast("string")})
    step = F.window("ts", "5 minutes").start.alias("step")
    values = {"max(value)": F.max("value"), "max(value) - 60": F.max("value") - 60, "count(*)::double": F.count("*"), "max(value) * 4": F.max("value") * 4}
    parts = []
    for alert, (kind, value, _, _) in _RULES.items():
        subject = F.lit("") if alert == "error_rate" else F.col("subject")
        parts.append(e.where(F.col("event_type") == kind).groupBy(step, subject.alias("subject")).agg(values[value].cast("double").alias("value")).withColumn("name", F.lit(live.ALERTS[alert][0])))
    some = e.where("value > 90 and user_id < 12").withColumn("name", F.when(F.col("event_type") == "error", "rejected").otherwise("connection_limit"))
    readings = live.increases(some, "ts", ["subject", "name"], F.lit(1))
    for p in parts:
        readings = readings.unionByName(p)
    return live.alerts(readings).withColumns({c: F.unix_seconds(c) for c in ("begin", "last")})


@query(CAPTURE + SHOWN + """, g as (select request_id, string_agg(upper(role) || ': ' || case when length(text) > 100 then substr(text, 1, 100) || '…[' || (length(text) - 100) || ' chars elided]' else text end, chr(10) || chr(10) order by m) as asked
  from shown where role <> 'assistant' group by 1), n as (select *, row_number() over (partition by c order by ms, request_id) as n from a)
select thread_id as thread_key, n, request_id, '--- turn ' || n || '  ' || strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') || '  ' || case when failed then 'error' else 'completed' end || coalesce(chr(10) || chr(10) || asked, '')
  || case when back1 is not null then chr(10) || chr(10) || 'RESULT: result of ' || back1 else '' end
  || case when text <> '' then chr(10) || chr(10) || 'ASSISTANT: ' || case when length(text) > 100 then substr(text, 1, 100) || '…[' || (length(text) - 100) || ' chars elided]' else text end else '' end
  || chr(10) || chr(10) || 'TOOL shell' || chr(10) || '{"cmd":"ls ' || t || '","secret_encrypted":"[encrypted]","task_name":"/root/task' || t || '","model":"m2","reasoning_effort":"low"}'
  || case when sub and request_id = first_value(request_id) over (partition by c order by t) then chr(10) || chr(10) || 'AGENT /root -> /root/a' || (c % 3) || ': go ' || c else '' end
  || case when failed then chr(10) || chr(10) || 'ERROR usage_limit used up ' || c else '' end as block from n left join g using (request_id)""")
def digest_blocks(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    out = live.digest_blocks(turns.assemble(f), items(f), {"prompt": 100, "message": 100})
    return out.select("thread_key", "n", "request_id", "block")


_TYPES = {"response.create": "true", "response.created": "true", "response.in_progress": "true", "response.output_text.delta": "true", "codex.rate_limits": "true", "codex.response.metadata": "true", "responsesapi.websocket_timing": "true", "error": "failed", "response.completed": "not failed"}


@query(CAPTURE + ", e as (" + " union all ".join(f"select '{k}' as ev, request_id, ms, c from a where {w}" for k, w in _TYPES.items()) + """
  union all select 'response.output_item.done', request_id, ms, c from a, range(4) r(i) where i < 3 or t % 3 = 0)
select 'event.type' as section, ev as subject, count(*) as n from e group by 2 union all select 'kind_event', 'responses ' || ev, count(*) from e group by 2 union all select 'lines', 'decoded', count(*) from e
union all select 'request_id_shape', 'ws_', count(*) from e union all select 'payload_framing', 'object', count(*) from e union all select 'filename', 'N-N-NTN.jsonl.gz', count(*) from e
union all select 'record.key', k, count(*) from e, (select unnest(['request_id', 'timestamp', 'account_id', 'headers', 'kind', 'transport', 'payload', 'extra']) as k) group by 2
union all select 'record.header', k, count(*) from e, (select unnest(['thread-id', 'session-id', 'originator', 'version', 'traceparent', 'x-codex-routing-hint', 'x-codex-window-id']) as k) group by 2
union all select 'record.field', k, count(*) from e, (select unnest(['kind=responses', 'transport=websocket', 'account_id=<set>']) as k) group by 2
union all select 'record.header_value', 'version=1.2', count(*) from e union all select 'record.header_value', 'originator=' || case when c % 13 = 12 then 'probe' else 'cli' end, count(*) from e group by 2""")
def capture_signature(spark: SparkSession, d: str) -> DataFrame:
    return profile.capture_signature(sessions(spark, d, raw=True)).where("section <> 'payload_shape'")


@query(CAPTURE + """, b as (select * from a where c % 13 <> 12), u as (select count(*) as bad from conversations where role = 'user'),
n as (select sum(10 + (not failed)::int + (t % 3 = 0)::int) as lines, sum(10 + (not failed)::int + (t % 3 = 0)::int) filter (c % 13 = 12) as probe from a)
select 'breaking' as severity, 'undecodable' as kind, 'per 10,000 lines' as subject, 0::bigint as was, (10000 * bad // (bad + lines))::bigint as "is" from n, u
union all select 'new', 'record.header_value', 'originator=probe', null, probe::bigint from n union all select 'info', 'event.type.absent', 'error', (select count(*) from b where failed), null union all select 'new', 'filename', 'odd', null, bad from u""")
def capture_drift(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d, raw=True))
    base = profile.capture_signature(f.where("headers['originator'] <> 'probe'"))
    broken = wire.decode(table(spark, d, "conversations").where("role = 'user'").select(F.lit("odd").alias("file"), F.col("turn").cast("long").alias("frame_seq"), F.lit("{broken").alias("raw")))
    now = profile.capture_signature(f.where("not ev_type <=> 'error'").unionByName(broken))
    # rows of a kind and event go with their type
    return profile.capture_drift(base, now).where("kind not in ('payload_shape', 'kind_event.absent')")


def _stream(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, str]:
    """A stream of a table's rows, by way of the shared folder, and where that is."""
    kept = checkpointed(rows)
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    return spark.readStream.schema(kept.schema).parquet(folder), folder.rsplit("/", 1)[0]


#: Rows that a file of a batch has; larger batches are written and read by several tasks.
BATCH_ROWS = 250_000


def _batches(spark: SparkSession, rows: DataFrame, by: str, n: int) -> tuple[DataFrame, str]:
    """A stream that gives a table's rows in ``n`` batches by a column's ranges, in no order inside a batch, and the folder it is below."""
    low, high, count = rows.agg(F.min(by), F.max(by), F.count("*")).first()
    part = F.floor((F.col(by) - F.lit(low)) * n / F.lit((high or 0) - (low or 0) + 1))
    folder = f"{shared_dir(spark)}/turnlake-batches-{uuid.uuid4().hex}"
    files = max(1, -(-count // (n * BATCH_ROWS)))
    none = spark.createDataFrame([], rows.schema).coalesce(1)
    for k in range(n):  # a stream takes files in the order in which they were written
        rows.where(part == k).repartition(files).sortWithinPartitions(F.xxhash64(by)).write.mode("append").parquet(f"{folder}/rows")
        there = len(spark.read.schema(rows.schema).parquet(f"{folder}/rows").inputFiles())
        for _ in range((k + 1) * files - there):  # a part without rows has no file, and would be made up for from the next batch
            none.write.mode("append").parquet(f"{folder}/rows")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/rows"), folder


@query("""with m as (select max(ts) as last from events) select epoch(date_trunc('hour', ts))::bigint as step, event_type, count(*) as n from events, m group by date_trunc('hour', ts), event_type, last
having date_trunc('hour', ts) + interval 1 hour <= last - interval 10 minutes""")
def streamed_windows(spark: SparkSession, d: str) -> DataFrame:
    stream, folder = _stream(spark, table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return jobs.drain(jobs.tumbling_counts(stream, "ts", "1 hour", ["event_type"]), folder).select(F.unix_seconds("step").alias("step"), "event_type", "n")


@query(CAPTURE + """, p as (select *, lag(calls) over w as prev, lag(sampled) over w as prev_sampled, lag(ms) over w as prev_ms from a window w as (partition by c, kind order by t)),
r as (select *, prev is null or ms - prev_ms > 1800000 as cold from p), q as (select *, cold or calls <= prev as reset from r)
select thread_id, kind, c * 1000000 + t * 100 + 10 as seq, reset, cold as baseline_reset, (calls - case when reset then 0 else prev end)::double as delta_calls, (sampled - case when reset then 0 else prev_sampled end)::double as delta_sampled_tokens from q""")
def streamed_deltas(spark: SparkSession, d: str) -> DataFrame:
    t = completed(spark, d).select("thread_id", F.col("request_kind").alias("kind"), F.col("timing_seq.frame_seq").alias("seq"), F.col("timing_ts").alias("ts"), "calls", "sampled_tokens")
    stream, folder = _stream(spark, t)
    out = jobs.drain(jobs.series_deltas(stream, ["thread_id", "kind"], "seq", "calls", ["calls", "sampled_tokens"], "ts"), folder)
    return out.select("thread_id", "kind", "seq", "reset", "baseline_reset", "delta_calls", "delta_sampled_tokens")


@query(CAPTURE + """, v as (select request_id, case when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model, case when failed then 'error' else 'completed' end as status, case when not failed then (size + 10)::varchar end as input_tokens,
  (t % 100)::double::varchar as limit_used, case when failed then 'used up ' || c end as error_message, (t + 1)::double::varchar as first_token_ms, text as answer from a)
select request_id, field, value from (unpivot v on model, status, input_tokens, limit_used, error_message, first_token_ms, answer into name field value value)""")
def turn_report(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d))
    t = timed(f)
    said = content.messages(f).groupBy("request_id", "instance").agg(F.max_by("body", F.struct("file", "frame_seq")).alias("answer"))
    fields = ["model", "status", "input_tokens", "limit_used", "error_message", "first_token_ms", "answer"]
    return reports.unpivot(t.join(said, ["request_id", "instance"], "left"), "request_id", fields)


@query(CAPTURE + SHOWN + """, p as (select c, t, 0 as k, m as pos, 'prompt' as record, text from shown union all select c, t, 1, 0, 'tool_output', 'result of ' || back1 from a where back1 is not null
  union all select c, min(t), 2, 0, 'agent_message', 'go ' || c from a where sub group by c
  union all select c, t, 3, 0, 'tool_call', '{"cmd":"ls ' || t || '","secret_encrypted":"[encrypted]","task_name":"/root/task' || t || '","model":"m2","reasoning_effort":"low"}' from a union all select c, t, 4, 0, 'message', text from a)
select 'conv-' || c as thread_id, string_agg(record || ': ' || text, chr(10) order by t, k, pos) as text from p group by c""")
def session_transcripts(spark: SparkSession, d: str) -> DataFrame:
    return reports.transcript(items(checkpointed(sessions(spark, d))), "thread_id", ["ts", "request_id", "ordinal"], F.concat_ws(": ", "record", "body"))


@query(CAPTURE + """, l as (select request_id, case when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model, kind, failed, c from a)
select request_id, 'family=' || case when c % 13 = 12 then 'probe' else 'websocket' end || ',model=' || model || ',record_type=turn,request_kind=' || kind || ',status=' || case when failed then 'error' else 'completed' end as labels, 'conv-' || c as thread, true as kept from l""")
def stream_labels(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(sessions(spark, d))
    beside = metrics.log_metadata(t.columns)
    return t.select("request_id", metrics.stable(metrics.stream_labels(t.columns, F.lit("turn"))).alias("labels"), beside["thread_id"].alias("thread"), (beside["model"].isNull() & beside["operation"].isNotNull()).alias("kept"))


@query(CAPTURE + """select request_id, thread_id, case when failed then 'error' else 'completed' end as status, 11 + (t % 3 = 0)::int as frames, kind as request_kind, 'turn_' || c || '_' || (t // 2) as turn_id,
  case when not failed then size + 10 end as input_tokens, case when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model, (t % 100)::double as limit_used, 'e' || c as models_etag from a""".replace("11 + (t % 3 = 0)::int", "(11 + (t % 3 = 0)::int)::bigint"))
def streamed_sessions(spark: SparkSession, d: str) -> DataFrame:
    stream, folder = _stream(spark, capture.capture(table(spark, d, "conversations")))
    done = jobs.close_stream(wire.decode(stream).drop("raw"), turns.assemble, folder)
    return done.select("request_id", "thread_id", "status", "frames", "request_kind", "turn_id", "input_tokens", "model", "limit_used", "models_etag")


@query(CAPTURE + """, p as (select c, min(t) as t from a where c = (select max(c) from a where back1 is not null) group by c)
select request_id, 11::bigint + (a.t % 3 = 0)::int as frames from a join p on a.c = p.c and (a.t = p.t or a.back1 = p.t)""")
def indexed_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The requests that name the first response of the last conversation with two: itself and its successor, from archives by way of their index."""
    c = table(spark, d, "conversations")
    folder = f"{shared_dir(spark)}/turnlake-archives-{uuid.uuid4().hex}"
    lines = capture.capture(c)
    lines.repartitionByRange(8, "frame_seq").sortWithinPartitions("frame_seq").select("raw").write.option("compression", "gzip").text(f"{folder}/a")
    index.update(spark, f"{folder}/a", f"{folder}/index", "*.txt.gz")
    two = capture.answers(c).where("back1 is not null").agg(F.max("conv_id").alias("conv_id"))
    first = capture.answers(c).join(two, "conv_id").agg(F.first("conv_id"), F.min("turn")).first()  # one row
    found = index.lookup(spark, f"{folder}/a", f"{folder}/index", f"resp_{first[0]}_{first[1]}", "*.txt.gz")
    return found.groupBy("request_id").agg(F.count("*").alias("frames"))


# Calls and outputs among the events: a fold over each user's, with ids that come again and rows without one.
CORRELATE = EVENTS.replace("with e", "with recursive e") + """,
s as (select *, case when k % 11 = 0 then '' else 'c' || k % 5 end as call_id, max(ts) over (partition by user_id order by event_id) - interval 24 hours as cutoff from e where event_type in ('click', 'view')),
o as (select *, row_number() over (partition by user_id, call_id order by event_id) as rn from s where call_id <> ''),
z as (select user_id, call_id, 0::bigint as rn, null::bigint as event_id, null::boolean as is_call, cast([] as struct(t timestamp, ref bigint, occ integer, done boolean)[]) as held, null::integer as occurrence, null::varchar as match, null::bigint as matched
    from o group by 1, 2
  union all
  select user_id, call_id, rn, event_id, is_call,
    case when is_call then list_append(live, {'t': ts, 'ref': event_id, 'occ': occ, 'done': false}) when len(waiting) = 1 then list_transform(live, lambda x: {'t': x.t, 'ref': x.ref, 'occ': x.occ, 'done': x.done or x.ref = waiting[1].ref}) else live end,
    case when is_call then occ when len(waiting) = 1 then waiting[1].occ end, case when is_call then null when len(waiting) = 1 then 'exact' when len(waiting) > 1 then 'ambiguous' else 'none' end, case when not is_call and len(waiting) = 1 then waiting[1].ref end
  from (select *, coalesce(list_max(list_transform(live, lambda x: x.occ)), 0)::integer + 1 as occ, list_filter(live, lambda x: not x.done) as waiting
    from (select o.user_id, o.call_id, o.rn, o.event_id, o.ts, o.event_type = 'click' as is_call, list_filter(z.held, lambda x: x.t >= o.cutoff) as live from z join o on o.user_id = z.user_id and o.call_id = z.call_id and o.rn = z.rn + 1)))
select user_id::varchar as thread, call_id, event_id, occurrence, match, matched::varchar as matched_ref from z where rn > 0
union all select user_id::varchar, call_id, event_id, null, case when event_type = 'view' then 'none' end, null from s where call_id = ''"""


def _calls(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.when(F.col("event_type") == "click", True).when(F.col("event_type") == "view", False)
    return events.select(F.col("user_id").cast("string").alias("thread"), F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("c"), (k % 5).cast("string"))).alias("call_id"), kind.alias("is_call"), "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("ref"))


@query(CORRELATE)
def call_correlation(spark: SparkSession, d: str) -> DataFrame:
    out = content.correlate(_calls(table(spark, d, "events")), "thread", "call_id", "is_call", "event_id", "ts", "ref")
    return out.select("thread", "call_id", "event_id", "occurrence", "match", "matched_ref")


@query(CORRELATE)
def streamed_correlation(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream of four batches, which follow each other in order and are mixed inside."""
    stream, folder = _batches(spark, table(spark, d, "events"), "event_id", 4)
    out = jobs.correlate_stream(_calls(stream), "thread", "call_id", "is_call", "event_id", "ts", "ref", folder)
    return out.select("thread", "call_id", "event_id", "occurrence", "match", "matched_ref")


# Events joined with the request of the same number that a log has 0 to 40 minutes later, some twice and some never.
_LOGGED = """with e as (select event_id, ts, case when event_id % 9 > 0 then event_id end as key from events), n as (select max(ts) as last from events),
l as (select event_id as key, ts + (event_id % 5) * interval 10 minutes as at, event_id % 3 + v as version from events, range(2) r(v) where event_id % 4 > 0 and (v = 0 or event_id % 6 = 0)),"""


def _log_of(events: DataFrame) -> DataFrame:
    e = events.where("event_id % 4 > 0").select("*", F.explode(F.when(F.col("event_id") % 6 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("v"))
    return e.select(F.col("event_id").alias("key"), F.expr("ts + make_interval(0, 0, 0, 0, 0, event_id % 5 * 10, 0)").alias("at"), (F.col("event_id") % 3 + F.col("v")).alias("version"))


@query(_LOGGED + """ j as (select e.event_id, e.ts, l.version from e left join l on e.key = l.key and l.at >= e.ts - interval 15 minutes and l.at <= e.ts + interval 15 minutes)
select event_id, version, coalesce(m.newest, version) as settled from j left join (select key, max(version) as newest from l group by 1) m on event_id = m.key and event_id % 9 > 0, n where ts < last - interval 3 hours""")
def streamed_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Events with their logs as two streams join them, and what late logs make of that; the last hours are left to the watermark."""
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = e.agg(F.max("ts") - F.expr("interval 3 hours")).first()[0]
    left, folder = _batches(spark, e.withColumn("key", F.when(F.col("event_id") % 9 > 0, F.col("event_id"))), "event_id", 3)
    logs = checkpointed(_log_of(e).withColumn("o", F.col("key")))
    right, _ = _batches(spark, logs, "o", 3)
    got = checkpointed(jobs.drain(jobs.attach_stream(left, right.drop("o"), "key", "ts", "at", late="1 hour"), folder))
    late = jobs.corrections(got.where("key is not null"), logs.drop("o"), "key", "version").select("key", F.col("log.version").alias("_newest"))
    rows = got.where(F.col("ts") < F.lit(last)).join(late, "key", "left")
    held = F.max("log.version").over(Window.partitionBy("event_id"))
    return rows.select("event_id", F.col("log.version").alias("version"), F.coalesce("_newest", held).alias("settled"))


@query("""with o as (select event_id, (user_id % 23)::varchar as v from events), f as (select v, row_number() over (order by min(event_id)) as i from o group by v),
r as (select event_id, case when i <= 9 then v else '_other' end as v from o join f using (v))
select v, count(*) as n, min(event_id) as first, max(event_id) as last, least((select count(*) from f), 9) as "distinct", (select count(*) from r where v = '_other') as rejected from r group by 1""")
def streamed_cap(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 23).cast("string").alias("v"))
    stream, folder = _batches(spark, e, "event_id", 4)
    rows, report = jobs.cap_stream(stream, "v", ["event_id"], 9, folder)
    g = rows.groupBy("v").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    return g.crossJoin(F.broadcast(report.drop("field")))  # one row


@query(CAPTURE + """select request_id, 'resp_' || c || '_' || t as response_id, case when failed then 'error' else 'completed' end as status, 11::bigint + (t % 3 = 0)::int as frames, true as numbered from a""")
def tailed_archives(spark: SparkSession, d: str) -> DataFrame:
    """Responses of archives that land in two halves, read on by a stream that stops in between; every file's lines are numbered without a gap."""
    lines = capture.capture(table(spark, d, "conversations")).repartitionByRange(8, "frame_seq").withColumn("part", F.spark_partition_id())
    folder = f"{shared_dir(spark)}/turnlake-archives-{uuid.uuid4().hex}"
    lines.sortWithinPartitions("part", "frame_seq").select("part", "raw").write.partitionBy("part").option("compression", "gzip").text(f"{folder}/coming")
    for half in (range(4), range(4, 8)):
        for k in half:
            land(spark, f"{folder}/coming/part={k}", f"{folder}/a/{k}")
        rows = jobs.drain(tail.stream(spark, f"{folder}/a", "*.txt.gz"), folder, name="tail")
    gaps = rows.groupBy("file").agg((F.max("frame_seq") + 1 == F.count_distinct("frame_seq")).alias("numbered")).agg(F.coalesce(F.bool_and("numbered"), F.lit(True)).alias("numbered"))
    out = turns.assemble(wire.decode(rows)).select("request_id", "response_id", "status", "frames")
    return out.crossJoin(F.broadcast(gaps))  # one row


@query("""with e as (select role as kind, conv_id, turn, conv_id || '-' || turn as id, case when turn % 3 = 0 then 'hot' || conv_id % 5 else 'e' || conv_id || '-' || turn end as mixed from conversations),
v as (select kind, 'conv' as path, conv_id::varchar as value from e union all select kind, 'id', id from e union all select kind, 'mixed', mixed from e union all select kind, 'place', (turn % 7)::varchar from e),
g as (select kind, path, value, count(*) as n from v where value is not null group by all), t as (select *, sum(n) over p as total, count(*) over p as d from g window p as (partition by kind, path)),
f as (select *, row_number() over (partition by kind, path order by n desc, value) as r from t where d <= 120 or n * 120 > total) select kind, path, value, n, d > 20 as capped from f where r <= 20""")
def frequent_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of documents with an id that never repeats, one that repeats evenly, one with a few frequent values among ids, and a short enum."""
    c, t, text = F.col("conv_id"), F.col("turn"), lambda x: x.cast("string")
    name = F.concat(text(c), F.lit("-"), text(t))
    mixed = F.when(t % 3 == 0, F.concat(F.lit("hot"), text(c % 5))).otherwise(F.concat(F.lit("e"), name))
    doc = F.to_json(F.struct(text(c).alias("conv"), name.alias("id"), mixed.alias("mixed"), text(t % 7).alias("place")))
    return profile.frequent_values(profile.paths(table(spark, d, "conversations").select("role", doc.alias("doc")), "role", "doc"), most=20, counters=120)


@query("""with recursive s as (select conv_id, length(coalesce(text, ''))::bigint as n, row_number() over (partition by conv_id order by turn) as rn from conversations),
r as (select conv_id, n, rn, 0 as chunk, n as used from s where rn = 1 union all
  select s.conv_id, s.n, s.rn, r.chunk + case when r.used > 0 and r.used + s.n > 1500 then 1 else 0 end, case when r.used > 0 and r.used + s.n > 1500 then s.n else r.used + s.n end from r join s on s.conv_id = r.conv_id and s.rn = r.rn + 1),
u as (select conv_id, sum(n)::bigint as chars, (max(chunk) + 1)::bigint as passes, case when conv_id % 4 > 0 and conv_id // 3 <> conv_id then conv_id // 3 end as up from r group by conv_id),
t as (select conv_id, conv_id as root from u where up is null or up not in (select conv_id from u) union all select u.conv_id, t.root from u join t on u.up = t.conv_id),
g as (select root as session, sum(chars)::bigint as chars, max(passes) filter (root = conv_id) as passes, count(*) - 1 as subagents, (sum(passes + (passes > 1)::int) + (count(*) > 1)::int)::bigint as calls from u join t using (conv_id) group by 1)
select * from g union all select null, coalesce(sum(chars), 0)::bigint, coalesce(sum(passes), 0)::bigint, coalesce(sum(subagents), 0)::bigint, coalesce(sum(calls), 0)::bigint + 1 from g""")
def digest_plan(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n"))
    units = threads.pack_chunks(c, ["conv_id"], "turn", "n", 1500).groupBy(F.col("conv_id").alias("node")).agg(F.sum("n").alias("chars"), (F.max("chunk") + 1).cast("long").alias("passes"))
    units = checkpointed(units)
    up = F.when((F.col("node") % 4 > 0) & (F.expr("node div 3") != F.col("node")), F.expr("node div 3"))
    return reports.digest_plan(units, threads.climb(units.select("node", up.alias("parent")), "node", "parent"))


@query(CAPTURE + """select request_id, case when not failed and t % 10 = 3 then 'safe' when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model, case when failed then 'sdk_error' end as category, 'codex' || case when sub then '/subagent' else '' end as agent,
  case when failed then 'primary' else '' end as limits from a""")
def turn_labels(spark: SparkSession, d: str) -> DataFrame:
    """The labels of a response that are derived from several of its columns."""
    c, t = F.col, turns.assemble(sessions(spark, d))
    limits = metrics.quota_names(turns.quota_failure(c("error_headers"))["active_limit"], c("error_headers"))
    return t.select(
        "request_id", metrics.response_model(c("safety_retry_model"), c("model")).alias("model"), metrics.failure(c("status"), c("error_type"), c("error_code")).alias("category"), metrics.agent_identity(c("thread_source")).alias("agent"), limits.alias("limits"),
    )


@query(CAPTURE + """, m as (select c, thread_id, '/root' as author, '/root/a' || (c % 3) as recipient from a where sub group by all)
select author, recipient, count(*) as messages, count(distinct thread_id) as threads from m group by 1, 2 order by 3 desc, 1, 2 limit 20""")
def message_graph(spark: SparkSession, d: str) -> DataFrame:
    return reports.message_edges(content.agent_messages(sessions(spark, d)))


#: The kind that each of six runs doesn't see; the fourth run fails.
_GONE = ("click", "view", "click", None, "click", "error")


@query(PATHS + f""", r as (select 'r' || i as run, (['click', 'view', 'click', '', 'click', 'error'])[i + 1] as gone from range({len(_GONE)}) t(i)),
g as (select run, gone, row_number() over (order by run) as n from r where gone <> ''),
f as (select 'info' as severity, 'absent' as what, kind, path, json_type, run, g.n from s join g on kind = gone),
i as (select *, n - row_number() over (partition by kind, path, json_type order by n) as island from f),
b as (select severity, what, kind, path, json_type, island, min(run) as first_seen, max(run) as last_seen, count(*) as k, max(n) as n from i group by all)
select severity, what, kind, path, json_type, min(first_seen) as first_seen, max(last_seen) as last_seen, sum(k)::bigint as runs, count(*) - 1 as flaps,
  case when max(n) = (select max(n) from g) then arg_max(k, n) else 0 end as streak, max(n) = (select max(n) from g) as current from b group by 1, 2, 3, 4, 5""")
def drift_history(spark: SparkSession, d: str) -> DataFrame:
    sig = checkpointed(profile.induce(profile.paths(table(spark, d, "events"), "event_type", "props")))
    folder = f"{shared_dir(spark)}/turnlake-runs-{uuid.uuid4().hex}"
    for i, gone in enumerate(_GONE):
        profile.record_run(profile.drift(sig, sig.where(F.col("kind") != gone)) if gone else None, f"r{i}", folder, spark)
    return profile.drift_history(*profile.recorded(spark, folder))


@query("select event_type, count(*) as events, count(*) as counted, sum(event_id)::bigint as ids from events group by 1")
def committed_sinks(spark: SparkSession, d: str) -> DataFrame:
    """Two tables of a stream of three batches, as their manifests show them: the rows, and counts of each batch."""
    e = table(spark, d, "events")
    stream, folder = _batches(spark, e, "event_id", 3)
    tables = lambda df: {"rows": df.select("event_id", "event_type"), "counts": df.groupBy("event_type").agg(F.count("*").alias("n"))}
    out = jobs.deliver(stream, tables, folder)
    rows = committed(spark, out, "rows", "event_id long, event_type string").groupBy("event_type").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))
    counts = committed(spark, out, "counts", "event_type string, n long").groupBy("event_type").agg(F.sum("n").alias("counted"))
    return rows.join(counts, "event_type")


@query(CAPTURE + """, k as (select count(*) as n, sum(11 + (t % 3 = 0)::int) as lines, count(*) filter (failed) as failed, count(distinct thread_id) as threads, count(distinct thread_id || kind) as series, max(ms + 1100) // 1000 as newest,
  count(*) filter ((c + t) % 11 > 0) as hits, count(*) filter ((c + t) % 11 = 0) as misses from a)
select 'lines' as name, lines::bigint as value from k union all select 'undecodable', 0 from k union all select 'deltas', n from k union all select 'newest', newest::bigint from k union all select 'emitted', n from k union all select 'errors', failed from k
union all select 'open', 0 from k union all select 'evicted', 0 from k union all select 'threads', threads from k union all select 'series', series from k union all select 'enriched', hits from k union all select 'not_enriched', misses from k
union all select 'drift_breaking', 0 from k union all select 'drift_new', 0 from k union all select 'drift_info', case when failed > 0 then 1 else 0 end from k""")
def health_rows(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(sessions(spark, d, raw=True))
    t = checkpointed(turns.assemble(f))
    logged = enrich.attach_log(t, capture.request_logs(table(spark, d, "conversations")))
    drift = profile.capture_drift(profile.capture_signature(f), profile.capture_signature(f.where("not ev_type <=> 'error'"))).where("kind <> 'event.volume'")
    return live.health_rows(f, t, logged, drift)
