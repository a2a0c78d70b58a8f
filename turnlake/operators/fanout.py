"""Log rows, spans and generation records from turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import metrics


def trace_id(thread: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(X.NUL, F.lit("thread"), thread), 256), 1, 32)


def span_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(X.NUL, *parts), 256), 33, 16)


def log_rows(turns: DataFrame, messages: DataFrame, prompts: DataFrame, types: tuple[str, ...] | None = None) -> DataFrame:
    """``record_type, ts, ordinal, thread_id, body`` of turns, their messages, prompts and errors, or of the chosen types."""
    out = turns.select(
        F.lit("turn").alias("record_type"), F.coalesce("last_ts", "first_ts").alias("ts"), F.lit(0).alias("ordinal"), "thread_id",
        F.to_json(F.struct("request_id", "status", "model", "input_tokens", "output_tokens")).alias("body"),
    ).unionByName(
        turns.where("status = 'error'").select(
            F.lit("error").alias("record_type"), F.coalesce("last_ts", "first_ts").alias("ts"), F.lit(0).alias("ordinal"), "thread_id",
            F.concat(F.col("error_type"), F.when(X.present(F.col("error_code")).isNotNull(), F.concat(F.lit(" ("), "error_code", F.lit(")"))).otherwise("")).alias("body"),
        )
    )
    for kind, rows in (("message", messages), ("prompt", prompts)):
        out = out.unionByName(rows.select(F.lit(kind).alias("record_type"), "ts", "ordinal", "thread_id", "body"))
    return out.where(F.col("record_type").isin(*types)) if types else out


def fit_body(rows: DataFrame, body: str, most: int) -> DataFrame:
    """Cut bodies to a byte budget at a character border; adds ``full_bytes`` where something was cut."""
    n = F.octet_length(body)
    return rows.withColumn("full_bytes", F.when(n > most, n)).withColumn(body, X.byte_cut(F.col(body), most))


def drop_late(rows: DataFrame, ts: str, now: Column, age: str = "3 hours") -> tuple[DataFrame, DataFrame]:
    """Rows young enough against the data's own clock, and the count of the others."""
    young = F.col(ts) >= now - F.expr(f"interval {age}")
    return rows.where(young), rows.agg(F.count_if(~young).alias("too_old"))


def spans(turns: DataFrame) -> DataFrame:
    """A root and a response span for each turn, with ids that depend on nothing but its names. Errors mark both."""
    base = turns.withColumns(
        {
            "trace_id": trace_id(F.coalesce("thread_id", "request_id")),
            "root": span_id(F.lit("turn"), F.col("request_id"), F.col("instance").cast("string")),
            "resp": span_id(F.lit("response"), F.col("request_id"), F.col("instance").cast("string")),
            "end": F.greatest("first_ts", "last_ts"),
            "state": F.when(F.col("status") == "error", "error").otherwise("ok"),
        }
    )
    link = F.when(F.col("parent_thread_id").isNotNull(), trace_id(F.col("parent_thread_id"))).alias("link_trace_id")
    root = base.select("trace_id", F.col("root").alias("span_id"), F.lit(None).cast("string").alias("parent_span_id"), F.lit("turn").alias("name"), F.col("first_ts").alias("start"), "end", "state", link)
    child = base.select("trace_id", F.col("resp").alias("span_id"), F.col("root").alias("parent_span_id"), F.concat_ws(" ", F.lit("response"), "model").alias("name"), F.col("first_ts").alias("start"), "end", "state", F.lit(None).cast("string").alias("link_trace_id"))
    return root.unionByName(child)


def phases(rows: DataFrame, keys: list[str], start: str, parts: dict[str, str]) -> DataFrame:
    """Lay phases (name to milliseconds column) end to end from a start time; phases without a positive length are left out."""
    items = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("phase"), F.col(c).cast("double").alias("ms")) for i, (k, c) in enumerate(parts.items())])
    e = rows.select(*keys, start, F.explode(F.filter(items, lambda p: p["ms"] > 0)).alias("p"))
    w = Window.partitionBy(*keys).orderBy("p.i")
    offset = F.coalesce(F.sum("p.ms").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return e.select(*keys, "p.phase", offset.alias("offset_ms"), (offset + F.col("p.ms")).alias("end_ms"))


def generations(turns: DataFrame, prompts: DataFrame, messages: DataFrame) -> DataFrame:
    """One nested record a turn: model, usage (null when all zero), error text, and its messages by ordinal."""
    items = lambda df, name: df.groupBy("request_id", "instance").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "role", "body"))), lambda x: F.struct(x["role"].alias("role"), x["body"].alias("text"))).alias(name))
    usage = F.struct("input_tokens", "output_tokens", "cached_tokens")
    some = F.greatest(*[F.coalesce(c, F.lit(0)) for c in ("input_tokens", "output_tokens", "cached_tokens")]) > 0
    df = turns.join(items(prompts, "input"), ["request_id", "instance"], "left").join(items(messages, "output"), ["request_id", "instance"], "left")
    error = F.when(F.col("status") == "error", F.concat("error_type", F.when(F.col("error_code").isNotNull(), F.concat(F.lit(" ("), "error_code", F.lit(")"))).otherwise("")))
    return df.select("request_id", "instance", "thread_id", "model", "status", F.when(some, usage).alias("usage"), error.alias("call_error"), "input", "output", X.short_hash(F.coalesce("instructions", F.lit(""))).alias("version"))


def result_links(matches: DataFrame, thread: str, ref: str, origin: Column, own: Column) -> DataFrame:
    """Spans of exact tool results from another response: their trace and the span of the call they answer."""
    exact = matches.where((F.col("match") == "exact") & (origin != own))
    t = F.col(thread).cast("string")
    return exact.select(thread, ref, trace_id(t).alias("trace_id"), span_id(F.lit("tool"), t, F.col("matched_ref").cast("string")).alias("link_span_id"))


def search_spans(spans: DataFrame, longer_ms: int) -> DataFrame:
    """``trace_id, longest_ms`` of traces with a span longer than the limit."""
    ms = F.floor((F.unix_micros("end") - F.unix_micros("start")) / 1000)
    return spans.groupBy("trace_id").agg(F.max(ms).alias("longest_ms")).where(F.col("longest_ms") > longer_ms)


def tool_spans(turns: DataFrame, key: str, calls: str, durations: str) -> DataFrame:
    """``key, occurrence, call_id, span_id, duration_ms``: a span for each call; durations count only when there is one for each."""
    known = F.when(F.size(durations) == F.size(calls), F.col(durations))
    e = turns.select(key, known.alias("_d"), F.posexplode(calls).alias("_i", "call_id"))
    n = (F.col("_i") + 1).alias("occurrence")
    sid = span_id(F.lit("tool"), F.col(key).cast("string"), F.col("call_id").cast("string"), (F.col("_i") + 1).cast("string"))
    return e.select(key, n, "call_id", sid.alias("span_id"), F.get("_d", F.col("_i")).alias("duration_ms"))


#: Bytes that a log line may have.
MAX_LINE = 65_536
INPUT_KINDS = ("prompt", "instructions", "tool_output", "agent_message")


def fit_text(fields: dict[str, Column], text: str, most: int) -> Column:
    """A JSON object of the fields whose ``text`` is cut to the longest start that keeps the whole within a byte budget.

    What is cut is the text as JSON writes it, at a border of characters and of escapes; ``full_bytes`` then says how long the text was. Null,
    to be dropped and counted, where not even an empty text fits. A null text is written as it is.
    """
    body = lambda t, *more: F.to_json(F.struct(*[(t if k == text else c).alias(k) for k, c in fields.items()], *more))
    once = lambda c, f: F.get(F.transform(F.array(c), f), F.lit(0))  # noqa: E731  (an expression that is used often and computed once)
    escaped = F.regexp_replace(F.to_json(F.array(fields[text])), r'^\["|"\]$', "")

    def cut(hole: Column) -> Column:
        at = F.locate(f'"{text}":""', hole) + len(text) + 3
        raw = F.substring(F.encode(escaped, "UTF-8"), F.lit(1), F.greatest(F.lit(most) - F.octet_length(hole), F.lit(0)))
        start = F.regexp_replace(once(raw, X.whole_characters), r"(?<!\\)((?:\\\\)*)\\(?:u[0-9A-Fa-f]{0,3})?$", "$1")
        return F.when(F.octet_length(hole) <= most, F.concat(F.substring(hole, F.lit(1), at), start, F.substring(hole, at + 1, F.length(hole))))

    empty = body(F.lit(""), F.octet_length(fields[text]).alias("full_bytes"))
    return once(body(fields[text]), lambda whole: F.when(F.octet_length(whole) <= most, whole).otherwise(once(empty, cut)))


def log_lines(turns: DataFrame, items: DataFrame, instructions: DataFrame, types: tuple[str, ...] | None = None, most: int = MAX_LINE) -> tuple[DataFrame, DataFrame]:
    """``record_type, ts, ordinal, request_id, instance, thread_id, body`` of all nine types of record, or of the chosen ones; and how many lines
    of each type are too long to be cut, and are dropped.

    ``items`` is the one table of content of a response, ``instructions`` each system prompt where it first came. What a response was given is
    logged at its start, what it gave at its end by the server's clock, else its last frame's; its fate at its last frame. Order is time, then
    ordinal. Null times stay null.
    """
    began, ended = F.coalesce("first_ts", "last_ts"), F.coalesce("server_completed", "last_ts", "first_ts")
    fate, key = F.coalesce("last_ts", "first_ts"), ["request_id", "instance"]
    c = F.col
    own = [k for k in ("status", "model", "effort", "tier", "response_id", "turn_id", "request_kind", "input_tokens", "output_tokens", "cached_tokens", "reasoning_tokens", "tool_calls", "messages", "frames", "bytes", "error_type") if k in turns.columns]
    head = lambda record, ts, body: [F.lit(record).alias("record_type"), ts.alias("ts"), F.lit(0).alias("ordinal"), *key, "thread_id", body.alias("body")]
    json = lambda *names: F.to_json(F.struct(*[c(n) for n in names]))
    transport = (c("status") == "transport") | c("close_code").isNotNull() | (c("frame_errors") > 0) | c("transport_event").isNotNull()
    failed = (c("status") == "error") | X.first_present(c("error_type"), c("error_code"), c("error_message")).isNotNull()
    rows = turns.select(*head("turn", ended, json(*own)))
    rows = rows.unionByName(turns.where(transport).select(*head("transport", fate, json("status", "close_code", "frame_errors", "transport_event"))))
    rows = rows.unionByName(turns.where(failed).select(*head("error", fate, json("error_type", "error_code", "error_message", "error_status"))))
    times = turns.select(*key, began.alias("_began"), ended.alias("_ended"))
    content = items.select("record", "ordinal", *key, "thread_id", "name", "recipient", "call_id", "body").unionByName(
        instructions.select(F.lit("instructions").alias("record"), F.lit(0).alias("ordinal"), *key, "thread_id", F.lit("instructions").alias("name"), *[F.lit(None).cast("string").alias(n) for n in ("recipient", "call_id")], "body")
    )
    content = content.join(times, key)
    line = fit_text({"ordinal": c("ordinal"), "name": c("name"), "recipient": c("recipient"), "call_id": c("call_id"), "text": c("body")}, "text", most)
    when = F.when(c("record").isin(*INPUT_KINDS), c("_began")).otherwise(c("_ended"))
    rows = rows.unionByName(content.select(c("record").alias("record_type"), when.alias("ts"), "ordinal", *key, "thread_id", line.alias("body")))
    rows = rows.withColumn("body", F.when(F.octet_length("body") <= most, F.col("body")))
    if types:
        rows = rows.where(c("record_type").isin(*types))
    return rows.where("body is not null"), rows.groupBy("record_type").agg(F.count_if(c("body").isNull()).alias("too_long"))


#: The critical path's phases in their order, and how far their sum may lie from the time they span.
PHASES = {"pre_inference": "pre_inference_ms", "engine_wall": "engine_ms", "sampling_and_stream": "sampling_ms", "client_tool_pause": "tool_pause_ms", "other": "other_ms"}


def _links(*links: Column) -> Column:
    return F.filter(F.array(*links), lambda x: x.isNotNull())


def _link(kind: str, trace: Column, span: Column) -> Column:
    return F.when(trace.isNotNull() & span.isNotNull(), F.struct(F.lit(kind).alias("kind"), trace.alias("trace_id"), span.alias("span_id")))


def call_span(thread: Column, call: Column, occurrence: Column) -> Column:
    return span_id(F.lit("tool"), F.coalesce(thread, F.lit("")), F.coalesce(call, F.lit("")), F.coalesce(occurrence, F.lit(0)).cast("string"))


def trace(turns: DataFrame, calls: DataFrame, outputs: DataFrame) -> DataFrame:
    """All spans of complete turns: ``trace_id, span_id, parent_span_id, name, start, end, state, links, attrs``.

    A turn's root holds its responses, each of which holds the phases of its critical path, laid end to end, its calls of tools, and results of other
    responses' calls. A root starts with the client, a response with the server, where they say when; ends are never before starts. Roots link to
    the client's connection and to the turn that spawned them, results to the call they answer. A root has the attributes of its last response, and
    is in error when any is. A call is as long as the server says only when
    there is a length for each call. What enrichment adds stands on the response only; spans of turns without any time start at the epoch.
    """
    c, epoch = F.col, F.timestamp_seconds(F.lit(0))
    ids = [c("request_id"), c("instance").cast("string")]
    start = F.coalesce("turn_start", "client_start", "server_created", "first_ts", epoch)
    base = turns.withColumns({
        "trace_id": trace_id(F.coalesce("thread_key", "request_id")), "root": F.when(c("turn_id").isNotNull(), span_id(F.lit("turn"), F.coalesce("thread_id", F.lit("")), c("turn_id"))).otherwise(span_id(F.lit("turn"), *ids)),
        "resp": span_id(F.lit("response"), *ids), "t0": start, "r0": F.coalesce("server_created", "first_ts", start), "failed": c("status") == "error",
    })
    base = base.withColumn("r1", F.greatest("r0", F.coalesce("server_completed", "last_ts", "r0")))
    state = F.when(c("failed"), "error").otherwise("ok")
    common = {k: c(k) for k in ("status", "model", "response_id", "thread_id", "turn_id", "request_kind") if k in turns.columns}
    extra = {k: c(k) for k in ("tier_outcome", "cost_usd", "api_key", "sticky_kind", "plan", "latency_ms", "temperature", "top_p") if k in turns.columns}
    attrs = lambda d: metrics.attributes(**d)
    none = F.array().cast("array<struct<kind: string, trace_id: string, span_id: string>>")
    row = lambda sid, parent, name, a, b, links=none, at=None, st=state: [c("trace_id"), sid.alias("span_id"), parent.alias("parent_span_id"), name.alias("name"), a.alias("start"), b.alias("end"), st.alias("state"), links.alias("links"), (at if at is not None else attrs(common)).alias("attrs")]
    spawner = _link("spawning_turn", F.when(c("parent_thread_id").isNotNull() & c("parent_turn_id").isNotNull(), trace_id(c("parent_thread_id"))), span_id(F.lit("turn"), c("parent_thread_id"), c("parent_turn_id")))
    op = F.when(F.coalesce("text_delta_count", "text_deltas") > 0, "streamText").otherwise("generateText") if "text_delta_count" in turns.columns else F.when(c("text_deltas") > 0, "streamText").otherwise("generateText")
    roots = base.select(*row(c("root"), F.lit(None).cast("string"), F.lit("turn"), c("t0"), F.greatest("t0", "r1"), _links(_link("connection", c("client_trace_id"), c("client_span_id")), spawner)))
    links = F.array_distinct(F.flatten(F.array_sort(F.collect_list("links"))))  # at most two for each response of a turn
    roots = roots.withColumn("_e", F.col("state") == "error").groupBy("trace_id", "span_id").agg(
        F.lit(None).cast("string").alias("parent_span_id"), F.lit("turn").alias("name"), F.min("start").alias("start"), F.max("end").alias("end"), F.when(F.max("_e"), "error").otherwise("ok").alias("state"),
        links.alias("links"), F.max_by("attrs", "end").alias("attrs"),
    )
    responses = base.select(*row(c("resp"), c("root"), F.concat_ws(" ", op, "model"), c("r0"), c("r1"), at=attrs(common | extra | {"operation": op, "provider": F.lit("openai")})))
    spans = roots.unionByName(responses)
    key = ["request_id", "instance"]
    if "critical" in turns.columns:
        items = F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(c(f"critical.{m}"), F.lit(0.0)).alias("ms")) for n, m in PHASES.items()])
        before = lambda xs, i: F.aggregate(F.slice(xs, F.lit(1), i), F.lit(0.0), lambda a, x: a + x["ms"])
        laid = F.filter(F.transform(items, lambda x, i: F.struct(x["name"].alias("name"), before(items, i).alias("at"), x["ms"].alias("ms"))), lambda x: x["ms"] > 0)
        fits = c("critical.coverage") != "missing_harness_boundary"
        moment = lambda ms: F.timestamp_micros((F.unix_micros("r0") + ms * 1000).cast("long"))
        e = base.where("critical is not null").select("*", F.explode(laid).alias("p"))
        spans = spans.unionByName(e.select(*row(span_id(F.lit("phase"), *ids, c("p.name")), c("resp"), F.concat(F.lit("critical_path."), "p.name"), moment(c("p.at")), moment(c("p.at") + c("p.ms")), at=attrs(common | {"coverage": c("critical.coverage"), "reconciled": fits}))))
    numbered = calls.withColumn("_i", F.row_number().over(Window.partitionBy(*key).orderBy("file", "frame_seq")) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(*key)))
    e = numbered.withColumnRenamed("name", "tool").select(*key, "tool", "call_id", "occurrence", "kind", "input", "task_name", F.col("status").alias("call_status"), "_i", "_n").join(base, key)
    tool_op = F.when(c("task_name").isNotNull(), F.lit("invoke_agent")).otherwise("execute_tool")
    lengths = F.when(F.size("new_tool_ms") == c("_n"), F.get("new_tool_ms", c("_i"))) if "new_tool_ms" in turns.columns else F.lit(None).cast("double")
    end = F.when(lengths > 0, F.timestamp_micros((F.unix_micros("r0") + lengths * 1000).cast("long"))).otherwise(c("r1"))
    of_call = attrs(common | {"tool": c("tool"), "call_id": c("call_id"), "tool_type": c("kind"), "arguments": X.byte_cut(c("input"), 16_384), "task": c("task_name"), "call_status": c("call_status")})
    spans = spans.unionByName(e.select(*row(call_span(c("thread_id"), c("call_id"), c("occurrence")), c("resp"), F.concat_ws(" ", tool_op, F.coalesce("task_name", X.present(c("tool")))), c("r0"), end, at=of_call)))
    o = outputs.where("match = 'exact'").select(*key, "call_id", "body", "origin", "pos").join(base, key).where("origin.request_id <> request_id or origin.instance <> instance")
    answered = _links(_link("origin_tool_call", c("trace_id"), call_span(c("thread_id"), c("call_id"), c("origin.occurrence"))))
    of_result = attrs(common | {"tool": c("origin.name"), "call_id": c("call_id"), "result": c("body"), "origin_request": c("origin.request_id")})
    return spans.unionByName(o.select(*row(span_id(F.lit("tool_result"), *ids, c("call_id"), c("pos").cast("string")), c("resp"), F.lit("tool_result"), c("r0"), c("r1"), answered, of_result)))


def find_spans(spans: DataFrame, name: str | None = None, pattern: str | None = None, state: str | None = None, longer_ms: int | None = None) -> DataFrame:
    """Spans by name, by a pattern that their whole name matches, by state and by length, newest first."""
    ms = (F.unix_micros("end") - F.unix_micros("start")) / 1000
    tests = [(name, F.col("name") == name), (pattern, metrics.label_matches(F.col("name"), pattern or "")), (state, F.col("state") == state), (longer_ms, ms > longer_ms if longer_ms is not None else None)]
    for given, test in tests:
        if given is not None:
            spans = spans.where(test)
    return spans.withColumn("ms", ms).orderBy(F.desc("start"), "span_id")


def call_error(error_type: Column, code: Column, message: Column) -> Column:
    """``type (code): message`` of what is present; null without a type."""
    kind = F.concat(error_type, F.coalesce(F.concat(F.lit(" ("), X.present(code), F.lit(")")), F.lit("")))
    return F.concat(kind, F.coalesce(F.concat(F.lit(": "), X.present(message)), F.lit("")))


def generation_documents(turns: DataFrame, items: DataFrame, instructions: DataFrame, catalogues: DataFrame) -> DataFrame:
    """One nested record for each response: ids, model, times, usage (null when all zero), error, messages in and out by ordinal, tools, version.

    In: prompts of users and assistants, and results of tools; out: messages and calls of tools. A response's items are its own, never its
    thread's. Tools are those of its catalogue first, then called ones that it doesn't name. The version is that of the instructions and tools.
    """
    key = ["request_id", "instance"]
    role = F.when(F.col("record") == "prompt", F.col("name")).when(F.col("record") == "tool_output", "tool").otherwise("assistant")
    side = F.when((F.col("record") == "tool_output") | (F.col("record") == "prompt") & F.col("name").isin("user", "assistant"), "input").when(F.col("record").isin("message", "tool_call"), "output")
    rows = items.withColumns({"_side": side, "_role": role}).where("_side is not null")
    entry = F.struct("ordinal", F.col("_role").alias("role"), F.col("record").alias("part"), F.when(F.col("record") == "tool_call", F.col("name")).alias("tool"), "call_id", F.col("body").alias("text"))
    side_of = lambda n: F.sort_array(F.collect_list(F.when(F.col("_side") == n, entry))).alias(n)
    called = F.array_sort(F.collect_list(F.when(F.col("record") == "tool_call", F.struct("ordinal", "name"))))
    g = rows.groupBy(*key).agg(side_of("input"), side_of("output"), F.array_distinct(F.transform(called, lambda x: x["name"])).alias("_called"))  # one response's items
    first = catalogues.where("first").select("tools_hash", F.transform("tools", lambda t: t["name"]).alias("_defined"))
    carried = catalogues.select(*key, "tools_hash").join(first, "tools_hash", "left")
    prompt = instructions.select(F.col("hash").alias("_hash"), F.col("body").alias("system_prompt"))
    df = turns.withColumn("_hash", X.short_hash(F.col("instructions"))).join(g, key, "left").join(carried, key, "left").join(prompt, "_hash", "left")
    tokens = [c for c in ("input_tokens", "output_tokens", "cached_tokens", "reasoning_tokens", "cache_write_tokens") if c in turns.columns]
    some = F.greatest(*[F.coalesce(c, F.lit(0)) for c in tokens], F.lit(0)) > 0
    blank = F.array().cast("array<string>")
    defined, used = F.coalesce("_defined", blank), F.coalesce("_called", blank)
    return df.select(
        *key, "response_id", "thread_id", "turn_id", "model", "effort", F.coalesce("server_created", "first_ts").alias("started"), F.coalesce("server_completed", "last_ts").alias("ended"),
        F.when(some, F.struct(*tokens)).alias("usage"), F.when(F.col("status") == "error", call_error(F.col("error_type"), F.col("error_code"), F.col("error_message"))).alias("call_error"),
        F.when(F.col("status") == "completed", "stop").otherwise(F.col("status")).alias("stop_reason"), "system_prompt", "input", "output", F.concat(defined, F.array_except(used, defined)).alias("tools"),
        X.short_hash(F.concat_ws(X.NUL, F.coalesce("_hash", F.lit("")), F.coalesce("tools_hash", F.lit("")))).alias("version"), metrics.attributes(status=F.col("status"), kind=F.col("request_kind"), family=F.col("family"), agent=F.col("agent_name")).alias("tags"),
    )
