"""Registered queries on whole sessions' frames: what a response is, asked for, gave, took and held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import content, enrich, metrics, registry, timing, turns
from turnlake.plans.queries import query
from turnlake.sources import capture
from turnlake.sources import frames as wire
from turnlake.sources.tables import checkpointed, table

#: Responses as the frames tell of them, one row each.
CAPTURE = """
with c as (select conv_id as c, turn as t, role, coalesce(text, '') as text from conversations),
a0 as (select *, case when t % 5 = 0 then 'memory' else 'turn' end as kind, strlen(text)::bigint as size, lag(t) over w as back1, lag(t, 2) over w as back2
  from c where role = 'assistant' window w as (partition by c order by t)),
a1 as (select *, sum(case when t % 4 = 0 then 1 else 0 end) over (partition by c, kind order by t) as part from a0),
a as (select *, row_number() over (partition by c, kind, part order by t) as calls, sum(size) over (partition by c, kind, part order by t) as sampled,
  (c + t) % 7 = 0 as failed, 'ws_' || c || '_' || t as request_id, 'resp_' || c || '_' || t as response_id, 'conv-' || c as thread_id, c // 3 as par, c // 3 <> c as sub,
  (1700000000 + c * 3600 + t * 60) * 1000 as ms from a1)
"""


def sessions(spark: SparkSession, d: str, raw: bool = False) -> DataFrame:
    """Decoded frames of the table's sessions, with what they belong to; or as they come, with the lines, which would be written twice."""
    frames = wire.decode(capture.capture(table(spark, d, "conversations")))
    return frames if raw else content.owned(frames.drop("raw"))


def completed(spark: SparkSession, d: str) -> DataFrame:
    """Turns with timing, of the table's sessions."""
    return timed(checkpointed(sessions(spark, d)))


def timed(frames: DataFrame) -> DataFrame:
    """Turns with timing, of frames. Turns with and without timing events go different ways, and both read the turns."""
    return timing.complete(checkpointed(turns.assemble(frames)), timing.timings(frames))


@query(CAPTURE + """select request_id, thread_id, 'sess-' || c as session_id, case when sub then 'conv-' || par end as parent_thread_id, sub as is_subagent, 'turn_' || c || '_' || (t // 2) as turn_id,
  kind as request_kind, case when sub then 'subagent' else 'user' end as thread_source, 'w' || c as window_id, nullif(t, 0) as window_number, 'agent ' || (c % 3) as agent_name, md5(c::varchar) as client_trace_id,
  '00f067aa0ba902b7' as client_span_id, '{"a":1,"b":' || t || '}' as workspaces, case when t % 6 = 1 then 'auto' end as compaction_trigger, case when c % 13 = 12 then 'probe' else 'cli' end as originator,
  case when c % 13 = 12 then 'probe' else 'websocket' end as family, thread_id as thread_key, ms - 1000 as turn_start, ms as client_start from a""")
def turn_identity(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(sessions(spark, d))
    return t.select(
        "request_id", "thread_id", "session_id", "parent_thread_id", "is_subagent", "turn_id", "request_kind", "thread_source", "window_id", "window_number", "agent_name", "client_trace_id",
        "client_span_id", "workspaces", "compaction_trigger", "originator", "family", "thread_key", F.unix_millis("turn_start").alias("turn_start"), F.unix_millis("client_start").alias("client_start"),
    )


@query(CAPTURE + """, h as (select a.request_id, count(*) as n from a join c on c.c = a.c and c.t < a.t and (select count(*) from c x where x.c = c.c and x.t >= c.t and x.t < a.t) <= 3 group by 1)
select request_id, case when not failed and t % 8 = 0 then 'm1b' else 'm1' end as model, 'high' as effort, 'auto' as reasoning_context, 'low' as verbosity, case when c % 2 = 0 then 'priority' end as tier_requested,
  case when failed then 'auto' else 'default' end as tier, 'u' || (c % 5) as safety_id, 'resp_' || c || '_' || back1 as previous_response_id, 'k' || c as prompt_cache_key, true as parallel_tools, 'auto' as cache_mode,
  1800.0::double as cache_ttl_seconds, 'hit' as cache_diagnostic, case when not failed then '24h' end as cache_retention,
  (coalesce(h.n, 0) + (back1 is not null)::int + (back2 is not null)::int + sub::int + 1)::int as input_items from a left join h using (request_id)""")
def turn_requests(spark: SparkSession, d: str) -> DataFrame:
    return turns.assemble(sessions(spark, d)).select(
        "request_id", "model", "effort", "reasoning_context", "verbosity", "tier_requested", "tier", "safety_id", "previous_response_id", "prompt_cache_key", "parallel_tools", "cache_mode",
        "cache_ttl_seconds", "cache_diagnostic", "cache_retention", "input_items",
    )


@query(CAPTURE + """select request_id, response_id, case when failed then 'error' else 'completed' end as status, case when not failed then size + 10 end as input_tokens, case when not failed then size end as output_tokens,
  case when not failed then 2 * size + 10 end as total_tokens, case when not failed then 2 end::bigint as cache_write_tokens, case when not failed then 3 end::bigint as reasoning_tokens,
  case when not failed then 4.0 / (size + 10) end::double as cache_ratio, case when not failed then size + 10 end as attributed_input_tokens, case when not failed then 3 end::bigint as attributed_output_tokens,
  case when not failed then ms + 250 end as created, case when not failed then ms + 5500 end as completed, case when not failed then 0.98 end::double as top_p, case when not failed then t % 3 end as web_searches,
  case when not failed then t % 2 end as image_tokens, not failed and t % 10 = 3 as safety_buffering, case when not failed and t % 10 = 3 then 'safe' end as safety_retry_model,
  case when failed then 'usage_limit' end as error_type, case when failed then 'used up ' || c end as error_message, case when failed then 429 end as error_status, case when failed then 60.0 end::double as quota_resets_in_seconds,
  'plus' as plan_type, 'e' || c as models_etag, 's' || t as turn_state, 5::bigint as reasoning_bytes,
  case when t % 4 > 1 then 'absent' when t % 4 = 0 and (failed or t % 8 > 0) then 'agree' else 'disagree' end as routing_hint from a""")
def turn_results(spark: SparkSession, d: str) -> DataFrame:
    return turns.assemble(sessions(spark, d)).select(
        "request_id", "response_id", "status", "input_tokens", "output_tokens", "total_tokens", "cache_write_tokens", "reasoning_tokens", "cache_ratio", "attributed_input_tokens", "attributed_output_tokens",
        F.unix_millis("server_created").alias("created"), F.unix_millis("server_completed").alias("completed"), "top_p", "web_searches", "image_tokens", "safety_buffering", "safety_retry_model", "error_type",
        "error_message", "error_status", "quota_resets_in_seconds", "plan_type", "models_etag", "turn_state", "reasoning_bytes", "routing_hint",
    )


@query(CAPTURE + """select request_id, 'codex' as family, 'primary' as "window", 97.0::double as used, 300.0::double as minutes, null::double as reset_at, c::double as reset, 'primary' as active_limit from a where failed""")
def quota_failures(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(sessions(spark, d)).where("status = 'error'")
    own = t.select("request_id", turns.quota_failure(F.col("error_headers"))["active_limit"].alias("active_limit"))
    return turns.quota_windows(t, "request_id", "error_headers").join(own, "request_id")


@query(CAPTURE + """select request_id, true as limit_allowed, t % 9 = 0 as limit_reached, (t % 100)::double as limit_used, 300 as limit_minutes, (c % 100)::double as limit_secondary_used, true as has_credits,
  false as credits_unlimited, 1000.5 + c % 10 as credits_balance, 'm2' as model, (c % 50)::double as model_used, false as model_reached from a""".replace("1000.5 + c % 10", "(1000.5 + c % 10)::double"))
def turn_limits(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(sessions(spark, d))
    by_model = turns.model_limits(t).select("request_id", "model", F.col("used").alias("model_used"), F.col("limit_reached").alias("model_reached"))
    own = t.select("request_id", "limit_allowed", "limit_reached", "limit_used", "limit_minutes", "limit_secondary_used", "has_credits", "credits_unlimited", "credits_balance")
    return own.join(by_model, "request_id")


_DELTAS = ", ".join(f"case when reset then calls else calls - prev end * {i + 1}.0::double as delta_{n}" for i, n in enumerate(timing.COUNTERS) if n != "sampled_tokens")


@query(CAPTURE + f""", p as (select *, lag(calls) over w as prev, lag(sampled) over w as prev_sampled, lag(ms) over w as prev_ms from a window w as (partition by c, kind order by t)),
r as (select *, prev is null or ms - (prev_ms + 1000) > 1800000 as cold from p), q as (select *, cold or calls <= prev as reset from r)
select request_id, reset, cold as baseline_reset, {_DELTAS}, (sampled - case when reset then 0 else prev_sampled end)::double as delta_sampled_tokens,
  case when reset then array_to_string(range(1, calls + 1), ',') else array_to_string(range(prev + 1, calls + 1), ',') end as new_tool_ms from q""")
def turn_deltas(spark: SparkSession, d: str) -> DataFrame:
    t = completed(spark, d)
    fresh = F.array_join(F.transform("new_tool_ms", lambda x: x.cast("int").cast("string")), ",")
    return t.select("request_id", "reset", "baseline_reset", *[f"delta_{n}" for n in timing.COUNTERS], fresh.alias("new_tool_ms"))


@query(CAPTURE + "select request_id, " + ", ".join(f"(t + {i})::double as {n}" for i, n in enumerate(timing.READINGS)) + """, case when t % 2 = 0 then 'complete' end as coverage, case when t % 2 = 0 then t * 10.0 end::double as engine_ms,
  case when t % 2 = 0 then t * 4.0 end::double as sampling_ms, 'logical_turn' as scope, 'turn_' || c || '_' || (t // 2) as logical_turn from a""")
def turn_readings(spark: SparkSession, d: str) -> DataFrame:
    t = completed(spark, d)
    return t.select("request_id", *timing.READINGS, "critical.coverage", "critical.engine_ms", "critical.sampling_ms", "scope", "logical_turn")


@query(CAPTURE + """select request_id, thread_id, 'function' as kind, 'shell' as name, 'call_' || c || '_' || t as call_id, '{"cmd":"ls ' || t || '","secret_encrypted":"[encrypted]","task_name":"/root/task' || t || '","model":"m2","reasoning_effort":"low"}' as input,
  1 as hidden, false as cut, '/root/task' || t as task_name, 'm2' as sub_model, 'low' as sub_effort, 1 as occurrence from a""")
def tool_calls(spark: SparkSession, d: str) -> DataFrame:
    return content.tool_calls(sessions(spark, d)).select("request_id", "thread_id", "kind", "name", "call_id", "input", "hidden", "cut", "task_name", "sub_model", "sub_effort", "occurrence")


@query(CAPTURE + """select request_id, thread_id, 'call_' || c || '_' || back1 as call_id, 'result of ' || back1 as body, strlen('result of ' || back1)::int as chars, false as cut, 'exact' as match, 'ws_' || c || '_' || back1 as origin_request
  from a where back1 is not null""")
def tool_outputs(spark: SparkSession, d: str) -> DataFrame:
    f = sessions(spark, d)
    out = content.matched_outputs(content.tool_calls(f), content.tool_outputs(f))
    return out.select("request_id", "thread_id", "call_id", "body", "chars", "cut", "match", F.col("origin.request_id").alias("origin_request"))


@query(CAPTURE + "select 'ws_' || c || '_' || min(t) as request_id, thread_id, '/root' as author, '/root/a' || (c % 3) as recipient, 'go ' || c as body from a where sub group by c, thread_id")
def agent_messages(spark: SparkSession, d: str) -> DataFrame:
    return content.agent_messages(sessions(spark, d)).select("request_id", "thread_id", "author", "recipient", "body")


@query(CAPTURE + """, k as (select *, '[{"description":"runs","name":"shell","strict":true,"type":"function"},{"description":"","name":"t' || (c % 4) || '","strict":false,"type":"custom"}]' as tools from a),
f as (select c % 4 as g, min(c * 1000000 + t) as o from a group by 1) select request_id, substr(sha256(tools), 1, 16) as tools_hash, c * 1000000 + t = o as first, case when c * 1000000 + t = o then 'shell,t' || g end as names from k join f on g = c % 4""")
def tool_catalogues(spark: SparkSession, d: str) -> DataFrame:
    out = content.tool_catalogues(sessions(spark, d))
    return out.select("request_id", "tools_hash", "first", F.array_join(F.transform("tools", lambda t: t["name"]), ",").alias("names"))


@query(CAPTURE + ", f as (select c % 3 as g, min(c * 1000000 + t) as o from a group by 1) select request_id, 'be ' || g as body, substr(sha256('be ' || g), 1, 16) as hash from f join a on c * 1000000 + t = o")
def instruction_bodies(spark: SparkSession, d: str) -> DataFrame:
    return content.instruction_bodies(sessions(spark, d)).select("request_id", "body", "hash")


@query(CAPTURE + """, h as (select a.request_id, c.t as m from a join c on c.c = a.c and c.t < a.t and (select count(*) from c x where x.c = c.c and x.t >= c.t and x.t < a.t) <= 3)
select request_id, k.kind, count(*) as n from h, (values ('user.text'), ('unknown')) k(kind) group by all""")
def declared_kinds(spark: SparkSession, d: str) -> DataFrame:
    return content.declared_kinds(sessions(spark, d)).select("request_id", "kind", "n")


def items(f: DataFrame) -> DataFrame:
    """All content of the frames, in one table with one ordinal."""
    given = checkpointed(content.input_items(f))
    return content.ordered(content.prompts(given), content.messages(f), content.tool_calls(f), content.tool_outputs(given), content.agent_messages(given))


#: First appearance of each message in the sessions' inputs: the response that re-sends it first; empty ones are never shown.
SHOWN = """, s as (select a.request_id, a.c, a.t, c.role, c.text, c.t as m, row_number() over (partition by c.c, c.role, c.text order by a.t, c.t) as first_time
  from a join c on c.c = a.c and c.t < a.t and (select count(*) from c x where x.c = c.c and x.t >= c.t and x.t < a.t) <= 3 where c.text <> ''),
shown as (select * from s where first_time = 1)"""


@query(CAPTURE + SHOWN + """, u as (select request_id, 0 as k, m as pos, 'prompt' as record, role as name from shown
  union all select request_id, 1, 0, 'tool_output', null from a where back1 is not null union all select 'ws_' || c || '_' || min(t), 2, 0, 'agent_message', '/root' from a where sub group by c
  union all select request_id, 3, 0, 'tool_call', 'shell' from a union all select request_id, 4, 0, 'message', null from a)
select request_id, record, name, row_number() over (partition by request_id order by k, pos)::int as ordinal from u""")
def content_ordinals(spark: SparkSession, d: str) -> DataFrame:
    return items(checkpointed(sessions(spark, d))).select("request_id", "record", "name", "ordinal")


def _accounts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, usage and key rights, from the suppliers."""
    s = table(spark, d, "supplier").selectExpr("concat('acct_', s_suppkey) as account_id", "concat('plan', s_nationkey % 3) as plan_type", "s_nationkey % 4 as n")
    u = table(spark, d, "lineitem").select(
        F.concat(F.lit("acct_"), F.col("l_suppkey").cast("string")).alias("account_id"), F.col("l_returnflag").alias("window"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("recorded_at"),
        F.col("l_quantity").alias("used"), F.col("l_tax").alias("reset"), F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice")).alias("credits"),
    )
    rights = s.selectExpr("account_id", "concat('key', n) as api_key").where("api_key < 'key3'")
    keys = table(spark, d, "region").selectExpr("concat('key', r_regionkey) as api_key")
    return s, u, enrich.eligibility(s.select("account_id"), keys, rights, "account_id", "api_key")


def _ended(spark: SparkSession, d: str) -> DataFrame:
    """Responses, two of three with a connection's last word in the place of a frame that they lack, and every fifth such word without a response."""
    c, t, say = F.col("conv_id"), F.col("turn"), lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])
    how = F.when(t % 3 == 1, "close").when(t % 3 == 2, "error")

    def frame(request: Column, place: int, text: Column, kind: Column, code: Column) -> Column:
        raw = F.to_json(F.struct(request.alias("request_id"), F.struct(text.alias("text")).alias("payload"), F.struct(kind.alias("frame_type"), code.alias("close_code")).alias("extra")))
        return F.struct((c * 1_000_000 + t * 100 + place).alias("frame_seq"), raw.alias("raw"))

    own = F.when(how.isNotNull(), frame(say("ws_", c, "_", t), 6, say("going ", t), how, F.when(how == "close", (c % 3 + 1000).cast("int"))))
    lone = F.when(t % 5 == 0, frame(F.lit(""), 50, say("bye ", c), F.lit("close"), F.lit(1012)))
    conversations = table(spark, d, "conversations")
    ends = conversations.where("role = 'assistant'").select(F.explode(F.array(own, lone)).alias("e")).where("e is not null").select("e.*")
    f = checkpointed(wire.decode(capture.capture(conversations).select("frame_seq", "raw").unionByName(ends).withColumn("file", F.lit("0"))))
    loose = turns.assemble(turns.loose(f).withColumn("request_id", F.concat(F.lit("frame-"), F.col("frame_seq").cast("string"))))
    return turns.assemble(f).unionByName(loose)


@query(CAPTURE + """select request_id, 12::bigint as frames, case when t % 3 > 0 then 'going ' || t end as transport_event, case when t % 3 = 1 then (1000 + c % 3)::int end as close_code, (t % 3 = 2)::int::bigint as frame_errors,
  case t % 3 when 1 then 'close' when 2 then 'error' end as frame_class from a
union all select 'frame-' || (c * 1000000 + t * 100 + 50), 1, 'bye ' || c, 1012, 0, 'close' from a where t % 5 = 0""")
def transport_ends(spark: SparkSession, d: str) -> DataFrame:
    t = _ended(spark, d)
    return t.select("request_id", "frames", "transport_event", "close_code", "frame_errors", metrics.frame_class(F.col("frame_errors"), F.col("close_code")).alias("frame_class"))


@query(CAPTURE + """, e as (select case when t % 3 = 1 then (1000 + c % 3)::varchar end as close_code from a where t % 3 > 0 union all select '1012' from a where t % 5 = 0)
select close_code, count(*)::double as n from e group by 1""")
def transport_events(spark: SparkSession, d: str) -> DataFrame:
    """The metric of the same, by the code of the close."""
    only = [m for m in registry.METRICS if m.name == "transport_events"]
    points = registry.points(_ended(spark, d), "last_ts", ["first_seq"], only)
    return points.groupBy(F.col("attrs")["close_code"].alias("close_code")).agg(F.sum("value").alias("n"))


def metric_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Everything that the registry reads, with ``ts`` and ``o`` in every table."""
    f = checkpointed(sessions(spark, d))
    t = timed(f)
    t = timing.measures(enrich.attach_log(t, capture.request_logs(table(spark, d, "conversations"))))
    t = checkpointed(t.withColumns({"ts": F.col("last_ts"), "o": F.struct("first_seq.file", "first_seq.frame_seq")}))
    of = lambda df: df.join(t.select("request_id", "instance", "ts", "o"), ["request_id", "instance"])
    accounts, usage, rights = _accounts(spark, d)
    snapshot = enrich.account_snapshot(accounts, usage)
    poll = lambda df: df.withColumns({"ts": F.lit(None).cast("timestamp"), "o": F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("frame_seq"))})
    quota = turns.quota_windows(t.where("status = 'error'").withColumn("key", F.struct("request_id", "instance", "account_id")), "key", "error_headers").select("key.*", "family", "window", "used", "reset")
    caps = metrics.cap_report(t, "thread_id", ["o"], 50)
    return {
        "turns": t, "tool_calls": content.tool_calls(f).withColumn("o", F.struct("file", "frame_seq")), "model_limits": of(turns.model_limits(t)), "quota": of(quota), "kinds": of(content.declared_kinds(f)),
        "accounts": poll(snapshot), "account_models": poll(snapshot.withColumn("quota_key", F.col("window"))), "keys": poll(rights), "caps": poll(caps),
    }


_N = {n: i + 1 for i, n in enumerate(timing.COUNTERS)}
_R = {n: i for i, n in enumerate(timing.READINGS)}
_OK, _LOG, _EVEN = "not failed", "(c + t) % 11 > 0", "t % 2 = 0"
_WAITS = {"queue": ("t", f"{_LOG} and {_EVEN}"), "gate": ("3", _LOG), "bridge": ("0", "false")}
#: What each metric has in all: its points' values and which responses have one.
POINTS = {
    "responses": ("1", "true"), "turns": ("1", "kind = 'turn'"), **{f"{m}_{k}": (v, w) for m in ("tokens", "token_usage") for k, v, w in (
        ("input", "size + 10", _OK), ("output", "size", f"{_OK} and size > 0"), ("cached", "4", _OK), ("reasoning", "3", _OK), ("cache_write", "2", _OK))},
    "cost_usd": ("t % 2 + t / 100", _LOG), **{f"proxy_wait_{k}": (f"{v} / 1000", w) for k, (v, w) in _WAITS.items() if w != "false"}, **{f"proxy_wait_{k}_present": (f"({w})::int", "true") for k, (_, w) in _WAITS.items()},
    "engine_calls": (f"case when {_EVEN} then 1 else delta end", f"{_EVEN} or delta > 0"), "tool_calls": ("1 + (t % 3 = 0)::int", "true"), "tool_calls_per_response": ("1 + (t % 3 = 0)::int", "true"), "tool_calls_by_name": ("1", "true"),
    "web_searches": ("t % 3", f"{_OK} and t % 3 > 0"), "image_tokens": ("t % 2", f"{_OK} and t % 2 > 0"), "errors": ("1", "failed"), "safety_buffering": ("1", f"{_OK} and t % 10 = 3"), "baseline_resets": ("1", "cold"),
    "operation_duration": ("5.25", _OK), "turn_duration": ("6.5", f"{_OK} and kind = 'turn'"), "time_to_first_token": (f"(t + {_R['first_token_ms']}) / 1000", "true"),
    "critical_path_engine": ("t * 10 / 1000", f"{_EVEN} and t > 0"), "critical_path_unblocked": ("5 / 1000", _EVEN), "critical_path_sampling": ("t * 4 / 1000", f"{_EVEN} and t > 0"),
    "critical_path_pre_inference": (f"case when {_EVEN} then 2 else t end / 1000", "true"), "critical_path_tool_pause": (f"{_N['tool_pause_ms']} * delta / 1000", f"not ({_EVEN}) and delta > 0"),
    **{k: (f"{_N[k + '_ms']} * delta / 1000", "delta > 0") for k in registry._EXCLUSIVE}, "uncached_prompt_tokens": (f"{_N['uncached_tokens']} * delta", "delta > 0"),
    **{f"time_between_tokens_{k}": (f"(t + {_R[f'tbt_{k}_ms']}) / 1000", "true") for k in ("engine", "api", "gap")},
    "limit_used": ("t % 100", "true"), "limit_reset": ("60", "true"), "limit_secondary_used": ("c % 100", "true"), "model_limit_used": ("c % 50", "true"), "credits_balance": ("1000.5 + c % 10", "true"), "credits_unlimited": ("0", "true"),
    "limit_reached": ("(t % 9 = 0)::int", "true"), "model_limit_reached": ("0", "true"), "quota_failures": ("1", "failed"), "quota_failure_used": ("97", "failed"), "quota_failure_reset": ("c", "failed"), "routing_hints": ("1", "true"),
    "compactions": ("1", "t % 6 = 1"), "tier_outcomes": ("1", "true"), "sticky_routing": ("1", f"{_LOG} and c % 2 = 0"), "proxy_latency": ("t * 10 / 1000", f"{_LOG} and t > 0"), "proxy_first_token": ("(t + 1) / 1000", _LOG),
}


@query(CAPTURE + """, p as (select *, lag(calls) over w as prev, lag(ms) over w as prev_ms from a window w as (partition by c, kind order by t)),
r as (select *, prev is null or ms - (prev_ms + 1000) > 1800000 as cold from p), q as (select *, case when cold or calls <= prev then calls else calls - prev end as delta from r),
h as (select a.request_id, count(*) as n from a join c on c.c = a.c and c.t < a.t and (select count(*) from c x where x.c = c.c and x.t >= c.t and x.t < a.t) <= 3 group by 1),
u as (select l_suppkey, l_returnflag, max_by({'q': l_quantity, 't': l_tax}, (l_shipdate, l_orderkey, l_linenumber)) as r from lineitem where l_suppkey in (select s_suppkey from supplier) group by all),
m as (select l_suppkey, max_by(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber)) as money from lineitem where l_discount > 0.05 group by 1),
s as (select supplier.*, u.l_returnflag, r, money from supplier left join u on s_suppkey = u.l_suppkey left join m on s_suppkey = m.l_suppkey),
g as (""" + " union all ".join(f"select '{k}' as metric, ({v})::double as v from q where {w}" for k, (v, w) in POINTS.items()) + """
 union all select 'content_items', n from h, range(2) union all select 'attributes_rejected', sum(n) from (select count(*) as n, row_number() over (order by min((ms // 3600000, c * 1000000 + t * 100))) as i from a group by thread_id) where i > 50
 union all select 'account_quota_used', r['q'] from s where r is not null union all select 'account_quota_reset', r['t'] from s where r is not null union all select 'account_model_quota_used', r['q'] from s where r is not null
 union all select 'account_credits', money from s where money is not null union all select 'account_info', 1 from s
 union all select 'key_eligible', (r_regionkey > 2 or s_nationkey % 4 = r_regionkey)::int from supplier, region)
select metric, count(*) as n, round(sum(v), 3)::double as total from g where metric <> 'attributes_rejected' or v > 0 group by 1""")
def wire_metrics(spark: SparkSession, d: str) -> DataFrame:
    rows = registry.all_points(metric_tables(spark, d), "ts", ["o"])
    return rows.groupBy("metric").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query(CAPTURE + """, o as (select c, t, case when (c + t) % 11 = 0 then 'miss' else 'hit' end as outcome, case when c % 2 = 1 then 'not_requested' when c % 4 = 0 and (c + t) % 11 > 0 then 'granted' else 'downgraded' end as tier_outcome from a)
select tier_outcome, outcome, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (partition by tier_outcome), 6)::double as share from o group by 1, 2""")
def log_outcomes(spark: SparkSession, d: str) -> DataFrame:
    t = enrich.attach_log(turns.assemble(sessions(spark, d)), capture.request_logs(table(spark, d, "conversations")))
    return enrich.outcomes(t, ["tier_outcome"]).withColumn("share", F.round("share", 6))
