"""Wire lines of whole agent sessions, rendered from the conversations table: input for the operators on frames, of any size.

Each assistant row is one response of a thread (its conversation), with the rows around it as history, calls of tools and their results,
limits, timing and an end. A response re-sends the last three rows and the last two results only, so the lines grow with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.operators.timing import COUNTERS, READINGS

BASE = 1_700_000_000


def _js(**k: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(n.replace("__", "-")) for n, v in k.items()]))


def _st(**k: Column) -> Column:
    return F.struct(*[v.alias(n.replace("__", "-")) for n, v in k.items()])


def _s(*parts: Column | str) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def answers(conversations: DataFrame) -> DataFrame:
    """One row for each response: what it re-sends and where its series stands. Null texts count as empty."""
    c, t = F.col("conv_id"), F.col("turn")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    item = _js(type=F.lit("message"), id=_s("m_", c, "_", t), role=F.col("role"), content=F.col("text"), internal_chat_message_metadata_passthrough=_st(content_item_kinds=F.array(F.lit("user.text"), _s("k", t % 2))))
    rows = rows.withColumn("history", F.collect_list(item).over(w.rowsBetween(-3, -1)))
    a = rows.where("role = 'assistant'").withColumns({"kind": F.when(t % 5 == 0, "memory").otherwise("turn"), "size": F.octet_length("text")})
    a = a.withColumns({f"back{k}": F.lag("turn", k).over(w) for k in (1, 2)})
    series = Window.partitionBy("conv_id", "kind").orderBy("turn")
    a = a.withColumn("part", F.sum(F.when(t % 4 == 0, 1).otherwise(0)).over(series))
    part = Window.partitionBy("conv_id", "kind", "part").orderBy("turn")
    return a.withColumns({"calls": F.row_number().over(part), "sampled": F.sum("size").over(part), "failed": (c + t) % 7 == 0})


def capture(conversations: DataFrame) -> DataFrame:
    """``(file, frame_seq, raw)``: gzip archives' lines in order. An empty table gives no lines."""
    c, t, lit = F.col("conv_id"), F.col("turn"), F.lit
    rid, parent = _s("ws_", c, "_", t), F.expr("conv_id div 3")
    typed = lambda kind, **k: _js(type=lit(kind), **k)
    # a result is sent with the next response, and once more after that
    results = [F.when(F.col(f"back{k}").isNotNull(), typed("function_call_output", id=_s("o_", c, "_", F.col(f"back{k}")), call_id=_s("call_", c, "_", F.col(f"back{k}")), output=_s("result of ", F.col(f"back{k}")))) for k in (2, 1)]
    agent = F.when(parent != c, typed("agent_message", author=lit("/root"), recipient=_s("/root/a", c % 3), content=_s("go ", c)))
    tools = typed("additional_tools", tools=F.array(_st(name=lit("shell"), type=lit("function"), description=lit("runs"), strict=lit(True)), _st(name=_s("t", c % 4), type=lit("custom"), description=lit(""), strict=lit(False))))
    items = F.filter(F.concat("history", F.array(*results, agent, tools)), lambda x: x.isNotNull())
    meta = _js(
        turn_id=_s("turn_", c, "_", F.expr("turn div 2")), request_kind=F.col("kind"), thread_source=F.when(parent != c, "subagent").otherwise("user"), window_number=t, agent_name=_s("agent ", c % 3),
        parent_thread_id=F.when(parent != c, _s("conv-", parent)), turn_started_at_unix_ms=(lit(BASE) + c * 3600 + t * 60 - 1) * 1000, workspaces=_js(b=t, a=lit(1)), compaction=_st(trigger=F.when(t % 6 == 1, "auto")),
    )
    client = _js(thread_id=F.when(c % 4 > 0, _s("conv-", c)), session_id=_s("sess-", c), **{"x__codex__turn__metadata": meta, "x__codex__ws__stream__request__start__ms": _s((lit(BASE) + c * 3600 + t * 60) * 1000)})
    own = lambda body, **raw: F.concat(F.expr("substring(_x, 1, length(_x) - 1)") if body is None else F.regexp_replace(body, r"\}$", ""), *[x for n, v in raw.items() for x in (lit(f',"{n}":'), v)], lit("}"))
    create = own(
        typed("response.create", model=lit("m1"), reasoning=_st(effort=lit("high"), context=lit("auto")), text=_st(verbosity=lit("low")), service_tier=F.when(c % 2 == 0, "priority"), instructions=_s("be ", c % 3),
              previous_response_id=F.when(F.col("back1").isNotNull(), _s("resp_", c, "_", F.col("back1"))), prompt_cache_key=_s("k", c), parallel_tool_calls=lit(True)),
        input=F.concat(lit("["), F.array_join(items, ","), lit("]")), client_metadata=client,
    )
    arguments = _js(cmd=_s("ls ", t), secret_encrypted=lit("zz"), task_name=_s("/root/task", t), model=lit("m2"), reasoning_effort=lit("low"))
    call = typed("response.output_item.done", item=_st(type=lit("function_call"), id=_s("f_", c, "_", t), name=lit("shell"), call_id=_s("call_", c, "_", t), status=lit("completed"), arguments=arguments))
    counters = {w: F.col("calls") * float(i + 1) for i, w in enumerate(COUNTERS.values())} | {COUNTERS["sampled_tokens"]: F.col("sampled")}
    readings = {w: (t + i).cast("double") for i, w in enumerate(READINGS.values())}
    timing = typed("responsesapi.websocket_timing", timing_metrics=_st(
        **counters, **readings, responsesapi_duration_excl_engine_per_tool_call_ms=F.transform(F.sequence(lit(1), "calls"), lambda x: x.cast("double")), timing_scope=lit("logical_turn"),
        critical_path=F.when(t % 2 == 0, _st(scope=lit("response"), coverage=lit("complete"), num_engine_calls=lit(1), engine_wall_ms=t * 10.0, responses_harness_unblocked_ms=lit(5.0), responses_pre_inference_ms=lit(2.0), sampling_and_stream_total_ms=t * 4.0, client_tool_pause_ms=lit(0.0)))))
    window = lambda used, minutes: _st(used_percent=used, window_minutes=lit(minutes), reset_after_seconds=lit(60.0))
    limits = own(typed("codex.rate_limits", plan_type=lit("plus"), rate_limits=_st(allowed=lit(True), limit_reached=t % 9 == 0, primary=window((t % 100) * 1.0, 300), secondary=window((c % 100) * 1.0, 10080)),
                       credits=_st(has_credits=lit(True), unlimited=lit(False), balance=_s("$1,00", c % 10, ".50"))),
                 additional_rate_limits=_js(m2=_st(limit_reached=lit(False), primary=window((c % 50) * 1.0, 60), secondary=window(lit(1.0), 0))))
    metadata = typed("codex.response.metadata", headers=F.create_map(lit("X-Models-Etag"), _s("e", c), lit("x-codex-turn-state"), _s("s", t)))
    usage = _st(input_tokens=F.col("size") + 10, output_tokens=F.col("size"), total_tokens=F.col("size") * 2 + 10, input_tokens_details=_st(cached_tokens=lit(4), cache_write_tokens=lit(2)), output_tokens_details=_st(reasoning_tokens=lit(3)),
                attribution=_st(items=F.create_map(lit("a"), _st(input_tokens=F.col("size"), output_tokens=lit(1)), lit("b"), _st(input_tokens=lit(10), output_tokens=lit(2)))))
    cache = _st(mode=lit("auto"), ttl=lit("30m"))
    completed = own(typed("response.completed", response=_st(id=_s("resp_", c, "_", t), status=lit("completed"), model=F.when(t % 8 == 0, "m1b"), service_tier=lit("default"), created_at=lit(BASE) + c * 3600 + t * 60 + 0.25,
                    completed_at=lit(BASE) + c * 3600 + t * 60 + 5.5, temperature=lit(1.0), top_p=lit(0.98), prompt_cache_retention=lit("24h"), usage=usage, tool_usage=_st(web_search=_st(num_requests=t % 3), image_gen=_st(total_tokens=t % 2)))),
                    safety_buffering=F.when(t % 10 == 3, lit('{"retry_model":"safe","use_cases":["u"],"reasons":["r"]}')).otherwise(lit("false")))
    failed = typed("error", error=_st(type=lit("usage_limit"), message=_s("used up ", c), plan_type=lit("plus"), resets_in_seconds=lit(60.0)), status=lit(429),
                   headers=F.create_map(lit("X-Codex-Primary-Used-Percent"), lit("97"), lit("x-codex-primary-window-minutes"), lit("300"), lit("x-codex-primary-reset-after-seconds"), _s(c), lit("x-codex-active-limit"), lit("primary"), lit("x-other-secondary-used-percent"), lit("")))
    message = typed("response.output_item.done", item=_st(type=lit("message"), id=_s("a_", c, "_", t), phase=lit("final"), content=F.array(_st(type=lit("output_text"), text=F.col("text")))))
    reasoning = typed("response.output_item.done", item=_st(type=lit("reasoning"), id=_s("r_", c, "_", t), encrypted_content=lit("gAAAA")))
    frames = [
        create, typed("response.created", response=_st(id=_s("resp_", c, "_", t), model=lit("m1"), service_tier=lit("auto"), safety_identifier=_s("u", c % 5), prompt_cache_options=cache)),
        typed("response.in_progress", response=_st(prompt_cache_diagnostics=_st(type=lit("hit")))), typed("response.output_text.delta", delta=lit("x")), reasoning, call, F.when(t % 3 == 0, call), message,
        limits, metadata, timing, F.when(F.col("failed"), failed).otherwise(completed),
    ]
    e = answers(conversations).select("*", F.posexplode(F.array(*frames)).alias("k", "ev")).where("ev is not null")
    time = F.timestamp_millis((lit(BASE) + c * 3600 + t * 60) * 1000 + F.col("k") * 100)
    headers = F.create_map(
        lit("Thread-Id"), _s("conv-", c), lit("Session-Id"), _s("sess-", c), lit("originator"), F.when(c % 13 == 12, "probe").otherwise("cli"), lit("version"), lit("1.2"), lit("traceparent"), _s("00-", F.md5(c.cast("string")), "-00f067aa0ba902b7-01"),
        lit("x-codex-routing-hint"), F.when(t % 4 == 0, "model=m1").when(t % 4 == 1, "model=m9").otherwise(""), lit("x-codex-window-id"), _s("w", c),
    )
    line = _js(request_id=rid, timestamp=F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), account_id=_s("acct_", c % 5), headers=headers, kind=lit("responses"), transport=lit("websocket"), payload=_st(text=F.col("ev")), extra=_st(frame_type=lit("text")))
    file = _s(F.date_format(time, "yyyy-MM-dd'T'HH"), ".jsonl.gz")
    return e.select(file.alias("file"), (c * 1_000_000 + t * 100 + F.col("k")).alias("frame_seq"), line.alias("raw"))


def request_logs(conversations: DataFrame) -> DataFrame:
    """A proxy's log of the same sessions: two versions of each second response's row, the newer one with its values, and some known by their request only."""
    c, t = F.col("conv_id"), F.col("turn")
    a = conversations.where("role = 'assistant'").select("conv_id", "turn", F.explode(F.array(F.lit(0), F.lit(1))).alias("v")).where("turn % 2 = 1 or v = 0")
    odd = t % 3 == 0
    return a.where("(conv_id + turn) % 11 > 0").select(
        F.when(~odd, _s("resp_", c, "_", t)).alias("request_id"), F.when(odd, _s("ws_", c, "_", t)).alias("archive_id"), (c * 1000 + t * 2 + F.col("v")).alias("id"), (F.col("v") == 5).alias("deleted"),
        (F.col("v") + t / 100).alias("cost_usd"), F.when(t % 2 == 0, t).alias("queue_wait_ms"), F.lit(3).alias("gate_wait_ms"), F.lit(None).cast("int").alias("bridge_wait_ms"), (t * 10).alias("latency_ms"), (t + 1).alias("first_token_ms"),
        F.when(c % 2 == 0, "thread").alias("sticky_kind"), F.lit("header").alias("sticky_source"), F.when(c % 4 == 0, "priority").when(c % 4 == 2, "default").alias("actual_tier"), _s("key", c % 3).alias("api_key"), F.lit("plus").alias("plan"),
        F.lit(200).alias("upstream_status"), F.lit("").alias("upstream_code"), F.lit("ws").alias("connection_kind"), F.lit("").alias("failure_phase"), _s("g", c % 2).alias("client_group"), F.lit(0).alias("retries"),
    )
