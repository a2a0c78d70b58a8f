"""What goes on: open responses, threads with what they do, surveys of a capture, its alerts, and its digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import metrics, reports

KEY = ("request_id", "instance")


def in_flight(turns: DataFrame, calls: DataFrame, messages: DataFrame, stall: str = "5 minutes", probes: bool = False) -> DataFrame:
    """Open responses with their last tool, its input, the last message and the last agent they spawned, how long they are quiet and whether
    they are stalled, by the capture's own clock, the newest frame anywhere. Probes are left out unless asked for. Order is first time, then id.
    """
    seq = F.struct("file", "frame_seq")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), seq))
    tools = calls.groupBy(*KEY).agg(last("name").alias("last_tool"), F.max_by("input", seq).alias("last_input"), last("task_name").alias("_task"))
    said = messages.groupBy(*KEY).agg(F.max_by("body", F.when(F.col("body") != "", seq)).alias("last_message"))
    now = turns.agg(F.max("last_ts").alias("_now"))
    open_ = turns.where("status = 'incomplete'")
    if not probes:
        open_ = open_.where("family <> 'probe'")
    df = open_.join(tools, [*KEY], "left").join(said, [*KEY], "left").crossJoin(F.broadcast(now))  # one row
    return df.select(
        *KEY, "thread_id", "first_ts", "last_ts", "text_deltas", "last_tool", "last_input", "last_message", task_name(F.col("_task")).alias("spawned_task"),
        (F.unix_millis("_now") - F.unix_millis("last_ts")).alias("quiet_ms"), (F.col("last_ts") < F.col("_now") - F.expr(f"interval {stall}")).alias("stalled"),
    ).orderBy("first_ts", *KEY)


def task_name(path: Column) -> Column:
    """The last part of a task's path; a path that ends in a slash is its own name."""
    last = F.element_at(F.split(path, "/"), -1)
    return X.present(F.when(last != "", last).otherwise(path))


def describe_tool(name: Column, text: Column) -> Column:
    shown = X.one_line(F.coalesce(text, F.lit("")), 80)
    return F.concat(F.coalesce(X.present(name), F.lit("tool")), F.when(shown != "", F.concat(F.lit(": "), shown)).otherwise(""))


def activity(turns: DataFrame, calls: DataFrame) -> DataFrame:
    """The turns with ``activity``: what each ended in, in a few words."""
    seq = F.struct("file", "frame_seq")
    tools = calls.groupBy(*KEY).agg(F.max_by("name", seq).alias("_tool"), F.max_by("input", seq).alias("_input"))
    words = (
        F.when(F.col("status") == "error", F.trim(F.concat_ws(" ", F.lit("error"), "error_type", "error_code")))
        .when(F.col("status") == "incomplete", "incomplete").when(F.col("status") == "transport", F.concat_ws(" ", F.lit("transport"), "transport_event"))
        .when(F.col("_tool").isNotNull(), describe_tool(F.col("_tool"), F.col("_input"))).otherwise("responded")
    )
    return turns.join(tools, [*KEY], "left").withColumn("activity", words).drop("_tool", "_input")


def spawned_tasks(calls: DataFrame, threads: DataFrame) -> DataFrame:
    """``thread_key, tasks``: the names of the distinct tasks that a thread's calls spawn, in order of first appearance."""
    named = calls.where("task_name <> ''").join(threads.select(*KEY, "thread_key"), [*KEY])
    first = named.groupBy("thread_key", "task_name").agg(F.min(F.struct("file", "frame_seq")).alias("o"))  # one row for each of a thread's tasks
    return first.groupBy("thread_key").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "task_name"))), lambda x: task_name(x["task_name"])).alias("tasks"))


def task_of(agents: DataFrame, threads: DataFrame) -> DataFrame:
    """``thread_key, task``: who a thread is, by whom its messages are for most often; of equals the least, and never the root."""
    rows = agents.where("recipient <> '' and recipient <> '/root'").join(threads.select(*KEY, "thread_key"), [*KEY])
    n = rows.groupBy("thread_key", "recipient").count()
    return n.groupBy("thread_key").agg(task_name(F.min_by("recipient", F.struct((-F.col("count")).alias("n"), "recipient"))).alias("task"))


def thread_table(turns: DataFrame, calls: DataFrame, messages: DataFrame, prompts: DataFrame, agents: DataFrame, stall: str = "5 minutes", probes: bool = False) -> DataFrame:
    """One row for each thread: what it did, what it is called and asked, what it says and does now, who its parent is, and whether it is stuck.

    Threads without an id go by their session; without either they are left out, as are probes unless asked for. Last values are the last that
    aren't null. A thread is running while a response is open, and stalled when one of these is quiet for longer than ``stall``.
    """
    rows = turns.where("thread_key is not null")
    if not probes:
        rows = rows.where("family <> 'probe'")
    seq = F.struct("last_ts", *KEY)
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), seq)).alias(c)
    said = messages.groupBy(*KEY).agg(X.one_line(F.max_by("body", F.when(F.col("body") != "", F.struct("file", "frame_seq"))), 200).alias("latest"))
    rows = activity(rows, calls).join(said, [*KEY], "left")
    now = turns.agg(F.max("last_ts").alias("_now"))
    rows = rows.crossJoin(F.broadcast(now))  # one row
    stuck = (F.col("status") == "incomplete") & (F.col("last_ts") < F.col("_now") - F.expr(f"interval {stall}"))
    g = rows.groupBy("thread_key").agg(
        F.count("*").alias("turns"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if(F.col("status") == "incomplete").alias("running"), F.count_if(stuck).alias("stalled"),
        *[F.sum(c).alias(c) for c in ("input_tokens", "output_tokens", "cached_tokens", "reasoning_tokens")], F.min("first_ts").alias("first_seen"), F.max("last_ts").alias("last_seen"),
        *[last(c) for c in ("model", "effort", "parent_thread_id", "subagent_kind", "forked_from_thread_id", "latest", "activity")], F.max("is_subagent").alias("is_subagent"),
        (F.unix_millis(F.max("_now")) - F.unix_millis(F.max("last_ts"))).alias("quiet_ms"),
    )
    asked = prompts.join(rows.where("not is_subagent").select(*KEY, "thread_key"), [*KEY])
    g = g.join(task_of(agents, rows), "thread_key", "left").join(reports.asks(asked, "thread_key", ["file", "frame_seq", "pos"]), "thread_key", "left").join(spawned_tasks(calls, rows), "thread_key", "left")
    kind = F.when(F.col("is_subagent") & F.col("forked_from_thread_id").isNotNull(), "fork").when(F.col("is_subagent"), "subagent").otherwise("session")
    return g.withColumn("name", X.first_present(F.col("task"), F.col("ask"), kind))


def event_survey(frames: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """``ev_type, frames, bytes, handled`` of every type of event in a capture; frames without an event are of type null, and handled."""
    g = frames.groupBy("ev_type").agg(F.count("*").alias("frames"), F.sum(F.octet_length("payload_text")).alias("bytes"))
    return g.withColumn("handled", F.coalesce(F.col("ev_type").isin(*known), F.lit(True)))


def response_survey(turns: DataFrame) -> DataFrame:
    """One row: responses, open and failed ones, those of sub-agents, and the distinct threads and logical turns."""
    return turns.agg(
        F.count("*").alias("responses"), F.count_if(F.col("status") == "incomplete").alias("incomplete"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if("is_subagent").alias("subagent"),
        F.countDistinct("thread_id").alias("threads"), F.countDistinct("logical_turn").alias("logical_turns"),
    )


def spawn_rates(turns: DataFrame, calls: DataFrame, step: str, seconds: int) -> DataFrame:
    """``step, thread_source, request_kind, model, turns, spawns``, per second: how often turns of a source and kind come, and agents are spawned."""
    spawns = calls.where("task_name is not null").groupBy(*KEY).agg(F.count("*").alias("n"))
    rows = turns.join(spawns, [*KEY], "left")
    g = rows.groupBy(F.window("last_ts", step).start.alias("step"), "thread_source", "request_kind", "model")
    return g.agg((F.count("*") / seconds).alias("turns"), (F.coalesce(F.sum("n"), F.lit(0)) / seconds).alias("spawns"))


def verdicts(attached: DataFrame) -> DataFrame:
    """``request_id, wire, proxy, disagree``: what the frames say of a response's end beside what the proxy's log says; null without a log."""
    wire = F.when(F.col("status") == "completed", "ok").when(F.col("status") == "incomplete", "open").otherwise("failed")
    proxy = F.when(F.col("upstream_status").isNotNull(), F.when(F.col("upstream_status") < 400, "ok").otherwise("failed"))
    return attached.select(*KEY, wire.alias("wire"), proxy.alias("proxy"), F.coalesce(wire != proxy, F.lit(False)).alias("disagree"))


#: The alert rules: what is watched, above which value, and for how many steps of five minutes in a row. Rejections and refused
#: connections are increases over the last fifteen minutes.
ALERTS = {
    "rate_limit_headroom": ("limit_used", 90.0, 2), "breaking_drift": ("breaking", 0.0, 1), "connection_limit": ("connection_limit", 0.0, 1), "log_rejections": ("rejected", 0.0, 1),
    "error_rate": ("error_rate", 0.5, 2), "ingest_lag": ("lag_seconds", 300.0, 1),
}
INCREASE = "15 minutes"


def increases(rows: DataFrame, ts: str, keys: list[str], value: Column, step: str = "5 minutes", over: str = INCREASE) -> DataFrame:
    """``step, keys, value``: for each step, the sum over all that lies within ``over`` before the step's end."""
    w = F.window(ts, over, step)
    g = rows.groupBy(w.alias("w"), *keys).agg(F.sum(value).cast("double").alias("value"))
    return g.select((F.col("w.end") - F.expr(f"interval {step}")).alias("step"), *keys, "value")


def watched(turns: DataFrame, step: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """``step, name, subject, value``: what the rules on turns watch, for each step: the highest limit used by every account, its connections
    refused within :data:`INCREASE` before the step's end, and the rate of errors of all. Readings of the pipeline itself and of drift come from
    elsewhere, in the same shape (rejected lines by :func:`increases`)."""
    w = F.window("last_ts", step).start.alias("step")
    owned = turns.where("account_id is not null").withColumn("subject", F.col("account_id"))
    used = owned.groupBy(w, "subject").agg(F.max("limit_used").alias("value")).select("step", F.lit("limit_used").alias("name"), "subject", F.col("value").cast("double").alias("value"))
    limit = owned.where(F.coalesce("error_code", F.col("error_type")) == "websocket_connection_limit_reached")
    refused = increases(limit, "last_ts", ["subject"], F.lit(1), step).select("step", F.lit("connection_limit").alias("name"), "subject", "value")
    errors = turns.groupBy(w).agg((F.count_if(F.col("status") == "error") / seconds).alias("value")).select("step", F.lit("error_rate").alias("name"), F.lit("").alias("subject"), "value")
    return used.unionByName(refused).unionByName(errors).where("value is not null")


def alerts(readings: DataFrame, seconds: int = 300, rules: dict[str, tuple[str, float, int]] = ALERTS) -> DataFrame:
    """``alert, subject, begin, last, steps``: the intervals in which each rule's reading stays above its value for long enough."""
    out = None
    for alert, (name, above, hold) in rules.items():
        found = metrics.breaches(readings.where(F.col("name") == name), ["subject"], "step", seconds, "value", above, hold).select(F.lit(alert).alias("alert"), "subject", "begin", "last", "steps")
        out = found if out is None else out.unionByName(found)
    return out


def digest_blocks(turns: DataFrame, items: DataFrame, most: dict[str, int] | None = None) -> DataFrame:
    """``thread_key, n, request_id, block``: each turn of a thread as the text a reader gets, turns without anything to read left out.

    Prompts come first, but for the assistant's own, then results (their head and tail), messages, calls with what they spawn, messages between
    agents, and the error. ``n`` numbers a thread's turns by time. One response's items are gathered; they are what one response holds.
    """
    most = {"prompt": 4_000, "tool_output": 2_000, "message": 4_000, "tool_call": 1_000, "agent_message": 4_000} | (most or {})
    c = F.col
    clip = lambda text, n: F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("…["), (F.length(text) - n).cast("string"), F.lit(" chars elided]"))).otherwise(text)
    rank = F.create_map(*[x for i, k in enumerate(("prompt", "tool_output", "message", "tool_call", "agent_message")) for x in (F.lit(k), F.lit(i))])
    half = most["tool_output"] // 2
    line = (
        F.when(c("record") == "prompt", F.concat(F.upper("name"), F.lit(": "), clip(c("body"), most["prompt"])))
        .when(c("record") == "tool_output", F.concat(F.lit("RESULT: "), X.head_tail(c("body"), half, half))).when(c("record") == "message", F.concat(F.lit("ASSISTANT: "), clip(c("body"), most["message"])))
        .when(c("record") == "tool_call", F.concat(F.lit("TOOL "), F.coalesce("name", F.lit("")), F.coalesce(F.concat(F.lit("\n"), X.present(clip(c("body"), most["tool_call"]))), F.lit(""))))
        .otherwise(F.concat(F.lit("AGENT "), F.coalesce(X.present(c("name")), F.lit("?")), F.lit(" -> "), F.coalesce(X.present(c("recipient")), F.lit("?")), F.lit(": "), clip(c("body"), most["agent_message"])))
    )
    shown = items.where("not (record = 'prompt' and name = 'assistant') and (record = 'tool_call' or body <> '')")
    g = shown.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct(rank[c("record")].alias("r"), "ordinal", line.alias("line")))).alias("x"))
    error = F.when((c("status") == "error") | c("error_type").isNotNull() | c("error_message").isNotNull(), F.concat_ws(" ", F.lit("ERROR"), "error_type", "error_code", clip(c("error_message"), 4_000)))
    df = turns.where("thread_key is not null").join(g, [*KEY], "left").withColumn("n", F.row_number().over(Window.partitionBy("thread_key").orderBy("first_ts", *KEY)))
    lines = F.concat(F.coalesce(F.transform("x", lambda x: x["line"]), F.array().cast("array<string>")), F.filter(F.array(error), lambda e: e.isNotNull()))
    head = F.concat_ws("  ", F.concat(F.lit("--- turn "), c("n").cast("string")), F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss"), X.present(c("status")))
    return df.where(F.size(lines) > 0).select("thread_key", "n", *KEY, F.array_join(F.concat(F.array(head), lines), "\n\n").alias("block"))


def health_rows(frames: DataFrame, turns: DataFrame, attached: DataFrame | None = None, findings: DataFrame | None = None, idle: str = "30 minutes") -> DataFrame:
    """``name, value``: what a pipeline says of itself: lines, those that don't decode, streaming deltas, the newest frame's time; responses that ended,
    failed, are open or were given up after being idle; threads and series; hits and misses of enrichment; and drift findings by severity, zeros too.
    """
    long = lambda c: c.cast("long")
    read = frames.agg(F.count("*").alias("lines"), F.count_if(~F.col("decode_ok")).alias("undecodable"), F.count_if("is_delta").alias("deltas"), F.unix_seconds(F.max("ts")).alias("newest"))
    now = turns.agg(F.max("last_ts").alias("_now"))
    open_, old = F.col("status") == "incomplete", F.col("last_ts") < F.col("_now") - F.expr(f"interval {idle}")
    made = turns.crossJoin(F.broadcast(now)).agg(  # one row
        F.count_if(~open_).alias("emitted"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if(open_ & ~old).alias("open"), F.count_if(open_ & old).alias("evicted"),
        F.countDistinct("thread_key").alias("threads"), F.countDistinct(F.struct("thread_key", F.coalesce("request_kind", F.lit("")))).alias("series"),
    )
    parts = [read, made]
    if attached is not None:
        parts.append(attached.agg(F.count_if(F.col("outcome") == "hit").alias("enriched"), F.count_if(F.col("outcome") == "miss").alias("not_enriched")))
    if findings is not None:
        parts.append(findings.agg(*[F.count_if(F.col("severity") == s).alias(f"drift_{s}") for s in ("breaking", "new", "info")]))
    rows = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), long(F.col(c)).alias("value")) for c in p.columns])).alias("x")).select("x.*") for p in parts]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
