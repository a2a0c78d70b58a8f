"""Frames to turns: one row per model response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.sources.frames import DELTAS, TERMINAL

ORDER = ("file", "frame_seq")
_WINDOW = "struct<used_percent: double, window_minutes: int, reset_after_seconds: double, reset_at: double>"
_LIMITS = f"struct<allowed: boolean, limit_reached: boolean, primary: {_WINDOW}, secondary: {_WINDOW}>"
_CACHE = "prompt_cache_options: struct<mode: string, ttl: string>, prompt_cache_diagnostics: struct<type: string>"
#: What the roll-up reads of an event: each is parsed once, whatever number of columns comes from it.
EVENT = (
    # create
    "model string, reasoning struct<effort: string, context: string, mode: string>, text struct<verbosity: string>, service_tier string, "
    "instructions string, previous_response_id string, prompt_cache_key string, parallel_tool_calls boolean, client_metadata struct<"
    "session_id: string, thread_id: string, turn_id: string, `x-codex-turn-metadata`: string, `x-codex-ws-stream-request-start-ms`: string, "
    "ws_request_header_x_openai_internal_codex_responses_lite: string, `x-openai-subagent`: string, `x-codex-parent-thread-id`: string>, "
    # created, in progress, completed
    f"safety_buffering string, response struct<id: string, model: string, status: string, service_tier: string, safety_identifier: string, {_CACHE}, "
    "created_at: double, completed_at: double, prompt_cache_retention: string, parallel_tool_calls: boolean, temperature: double, top_p: double, "
    "reasoning: struct<context: string, mode: string>, tool_usage: struct<web_search: struct<num_requests: long>, image_gen: struct<total_tokens: long>>, "
    "usage: struct<input_tokens: string, output_tokens: string, total_tokens: string, input_tokens_details: struct<cached_tokens: string, "
    "cache_write_tokens: string>, output_tokens_details: struct<reasoning_tokens: string>, attribution: struct<items: map<string, struct<"
    "input_tokens: long, output_tokens: long, cached_tokens: long, cache_write_tokens: long>>>>>, "
    # output items
    "item struct<type: string, encrypted_content: string>, "
    # errors, response metadata
    "error struct<type: string, code: string, message: string, plan_type: string, resets_at: double, resets_in_seconds: double>, "
    "status_code string, status string, headers map<string,string>, "
    # limits
    f"plan_type string, rate_limits {_LIMITS}, additional_rate_limits map<string, {_LIMITS}>, "
    "credits struct<has_credits: boolean, unlimited: boolean, balance: string>"
)
_COMPACTION = ("trigger", "reason", "implementation", "phase", "strategy")
#: The turn metadata, a document inside a string: what only the body may say, and what the first frame's header may say as well.
META_OWN = ("turn_id", "request_kind", "thread_source", "sandbox", "turn_trigger", "forked_from_thread_id", "subagent_kind", "window_id", "installation_id", "parent_thread_id", "parent_turn_id")
META_EITHER = ("root_turn_id", "agent_name", "sandbox_mode", "window_number", "context_window_id", "workspaces")
META = ", ".join(f"{c} string" for c in (*META_OWN, *META_EITHER, "turn_started_at_unix_ms")) + f", compaction struct<{', '.join(f'{c}: string' for c in _COMPACTION)}>"


def segment(frames: DataFrame) -> DataFrame:
    """Add ``instance``: a terminal event that decodes closes a response, and later frames of the same request open the next. Frames that have one
    stay as they are."""
    if "instance" in frames.columns:
        return frames
    w = Window.partitionBy("request_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    ends = F.when(F.col("ev_type").isin(*TERMINAL) & F.col("event").isNotNull(), 1).otherwise(0)
    keyed = frames.where("request_id <> ''")
    return keyed.withColumn("instance", F.coalesce(F.sum(ends).over(w), F.lit(0)))


def loose(frames: DataFrame) -> DataFrame:
    """Frames without a request: protocol errors and transport frames become turns of one frame, others are dropped."""
    return frames.where("coalesce(request_id, '') = '' and (ev_type = 'error' or is_transport)")


def _get(path: str, kind: str = "string") -> Column:
    return F.get_json_object("event", path) if kind == "string" else F.get_json_object("event", path).try_cast(kind)


def _last(value: Column, when: Column) -> Column:
    return F.max_by(F.when(when, value), F.when(when & value.isNotNull(), F.struct(*ORDER)))


def _first(value: Column, when: Column | None = None) -> Column:
    ok = value.isNotNull() if when is None else when & value.isNotNull()
    return F.min_by(F.when(ok, value), F.when(ok, F.struct(*ORDER)))


def _document(event_type: str, *fields: str, also: Column | None = None) -> Column:
    """The named parts of a response's last event of a type that decodes, as a struct."""
    when = F.col("ev_type").isin(*event_type.split("|")) & F.col("_e").isNotNull()
    value = F.struct(*[F.col(f"_e.{f}").alias(f.replace("response.", "")) for f in fields], *([also] if also is not None else []))
    return F.max_by(value, F.when(when, F.struct(*ORDER)))


def _header(name: str) -> Column:
    return X.present(F.col("headers")[name])


def assemble(frames: DataFrame) -> DataFrame:
    """One row per response instance, by a single aggregation on the request; open instances have the status ``incomplete``.

    Identity comes from the instance's first frame, and what the body of its create event says of itself goes before that: headers are
    written when a connection opens and go stale. Of each type of event the last one counts. Absent values are null; a frame without a
    request belongs to no row; an empty capture gives an empty table. Rows of equal position fall together in any order.
    """
    df = segment(frames).withColumn("_e", F.from_json("event", EVENT))
    is_ = lambda *t: F.col("ev_type").isin(*t)
    create, done, error, item = is_("response.create"), is_("response.completed"), is_("error"), is_("response.output_item.done")
    item_type, seq = F.col("_e.item.type"), F.struct(*ORDER)
    decoded = F.col("event").isNotNull()
    first = F.struct(
        *[_header(h).alias(n) for n, h in {
            "session": "session-id", "thread": "thread-id", "parent": "x-parent-thread-id", "codex_parent": "x-codex-parent-thread-id", "installation": "x-codex-installation-id", "window": "x-codex-window-id",
            "originator": "originator", "version": "version", "subagent": "x-openai-subagent", "trace": "traceparent", "metadata": "x-codex-turn-metadata",
        }.items()], "account_id", "family", F.col("ts").alias("ts"),
    )
    delta_safety = F.when((F.col("ev_type") == DELTAS[0]) & F.col("payload_text").contains('"safety_buffering"'), F.get_json_object("payload_text", "$.safety_buffering"))
    safety = F.coalesce(F.when(done, F.col("_e.safety_buffering")), delta_safety)
    usage = "response.usage"
    turns = df.groupBy("request_id", "instance").agg(
        F.min_by(first, seq).alias("fi"),
        F.count("*").alias("frames"),
        F.sum(F.octet_length("payload_text")).alias("bytes"),
        F.max_by("ts", seq).alias("last_ts"),
        F.min(seq).alias("first_seq"),
        F.max(seq).alias("last_seq"),
        F.count_if(is_(DELTAS[0])).alias("text_deltas"),
        F.count_if(F.col("is_delta") & ~is_(DELTAS[0])).alias("tool_deltas"),
        _last(F.col("close_code"), F.col("is_transport")).alias("close_code"),
        F.count_if(F.col("frame_type") == "error").alias("frame_errors"),
        _first(X.present(F.col("payload_text")), F.col("is_transport")).alias("transport_event"),
        _document("response.create", "model", "reasoning", "text", "service_tier", "instructions", "previous_response_id", "prompt_cache_key", "parallel_tool_calls", "client_metadata",
                  also=F.json_array_length(F.get_json_object("event", "$.input")).alias("inputs")).alias("cr"),
        _document("response.created", "response.id", "response.model", "response.service_tier", "response.safety_identifier", "response.prompt_cache_options", "response.prompt_cache_diagnostics").alias("cd"),
        _document("response.in_progress", "response.prompt_cache_options", "response.prompt_cache_diagnostics").alias("ip"),
        _document("response.completed", "response").alias("co"),
        _document("error", "error", "status_code", "status", "headers").alias("er"),
        _document("codex.rate_limits", "plan_type", "rate_limits", "additional_rate_limits", "credits").alias("rl"),
        _document("codex.response.metadata|response.metadata", "headers").alias("me"),
        _last(_header("x-codex-routing-hint"), create | is_("response.created") | error | done).alias("_hint"),
        _last(safety, ~safety.isin("false", "null")).alias("_safety"),
        F.count_if(item & item_type.isin("function_call", "custom_tool_call")).alias("tool_calls"),
        F.count_if(item & (item_type == "message")).alias("messages"),
        F.sum(F.when(item & (item_type == "reasoning"), F.octet_length("_e.item.encrypted_content"))).alias("reasoning_bytes"),
        F.max(F.when(error, 1).otherwise(0)).alias("_failed"),
        F.max(F.when(done & decoded, 1).otherwise(0)).alias("_done"),
    )
    turns = turns.withColumns({
        "_m": F.from_json("cr.client_metadata.x-codex-turn-metadata", META),
        "_h": F.from_json("fi.metadata", META),
        "_c": F.col("cr.client_metadata"),
        "_r": F.col("co.response"),
        "_u": F.col(f"co.{usage}"),
    })
    some, num = X.first_present, lambda c: F.col(c).try_cast("long")
    c = F.col
    attributed = lambda k: F.aggregate(F.map_values(c("_u.attribution.items")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x[k], F.lit(0).cast("long")))
    trace = F.split(c("fi.trace"), "-")
    cache = lambda f: F.coalesce(*[X.present(c(f"{d}.{f}")) for d in ("_r", "ip", "cd")])
    ms = lambda column: F.when(column.try_cast("long") > 0, F.timestamp_millis(column.try_cast("long")))
    either = {k: some(c(f"_m.{k}"), c(f"_h.{k}")) for k in META_EITHER if k not in ("workspaces", "window_number")}
    model = some(c("_r.model"), c("cr.model"), c("cd.model"))
    kind = F.schema_of_variant(F.try_parse_json("_safety"))
    parent = some(c("_m.parent_thread_id"), c("_c.x-codex-parent-thread-id"), c("fi.codex_parent"), c("fi.parent"))
    status = F.when(c("_failed") == 1, "error").when(c("_done") == 1, F.coalesce("_r.status", F.lit("completed"))).otherwise("incomplete")
    own = {
        "thread_id": some(c("_c.thread_id"), c("fi.thread")), "session_id": some(c("_c.session_id"), c("fi.session")),
        "parent_thread_id": parent, "is_subagent": parent.isNotNull(), "turn_id": some(c("_m.turn_id"), c("_c.turn_id")), "account_id": c("fi.account_id"), "family": c("fi.family"), "first_ts": c("fi.ts"),
        "installation_id": some(c("_m.installation_id"), c("fi.installation")), "window_id": some(c("_m.window_id"), c("fi.window")),
        "originator": c("fi.originator"), "client_version": c("fi.version"), "subagent_kind": some(c("_m.subagent_kind"), c("_c.x-openai-subagent"), c("fi.subagent")),
        "client_trace_id": F.when(F.size(trace) == 4, trace[1]), "client_span_id": F.when(F.size(trace) == 4, trace[2]),
        **{k: X.present(c(f"_m.{k}")) for k in ("request_kind", "thread_source", "sandbox", "turn_trigger", "forked_from_thread_id", "parent_turn_id")}, **either,
        "window_number": F.coalesce(*[F.nullif(num(f"{d}.window_number"), F.lit(0)) for d in ("_m", "_h")]),
        "workspaces": F.coalesce(*[F.when(c(f"{d}.workspaces").startswith("{"), X.canonical_json(c(f"{d}.workspaces"))) for d in ("_m", "_h")]),
        **{f"compaction_{k}": some(c(f"_m.compaction.{k}"), c(f"_h.compaction.{k}")) for k in _COMPACTION},
        "turn_start": ms(c("_m.turn_started_at_unix_ms")), "client_start": ms(c("_c.x-codex-ws-stream-request-start-ms")),
        "lite": F.coalesce(c("_c.ws_request_header_x_openai_internal_codex_responses_lite") == "true", F.lit(False)),
        "model": model, "effort": X.present(c("cr.reasoning.effort")), "reasoning_context": some(c("_r.reasoning.context"), c("cr.reasoning.context")),
        "reasoning_mode": some(c("_r.reasoning.mode"), c("cr.reasoning.mode")), "verbosity": X.present(c("cr.text.verbosity")),
        "tier_requested": X.present(c("cr.service_tier")), "tier": some(c("_r.service_tier"), c("cd.service_tier")), "safety_id": some(c("_r.safety_identifier"), c("cd.safety_identifier")),
        "input_items": c("cr.inputs"), "previous_response_id": X.present(c("cr.previous_response_id")), "prompt_cache_key": X.present(c("cr.prompt_cache_key")),
        "parallel_tools": F.coalesce(c("cr.parallel_tool_calls"), F.lit(False)) | F.coalesce(c("_r.parallel_tool_calls"), F.lit(False)),
        "response_id": some(c("cd.id"), c("_r.id")), "instructions": c("cr.instructions"),
        "cache_mode": cache("prompt_cache_options.mode"), "cache_ttl_seconds": F.coalesce(*[X.duration_seconds(c(f"{d}.prompt_cache_options.ttl")) for d in ("_r", "ip", "cd")]),
        "cache_diagnostic": cache("prompt_cache_diagnostics.type"), "cache_retention": X.present(c("_r.prompt_cache_retention")),
        "temperature": c("_r.temperature"), "top_p": c("_r.top_p"), "server_created": X.epoch_time(c("_r.created_at")), "server_completed": X.epoch_time(c("_r.completed_at")),
        "web_searches": c("_r.tool_usage.web_search.num_requests"), "image_tokens": c("_r.tool_usage.image_gen.total_tokens"),
        "input_tokens": num("_u.input_tokens"), "output_tokens": num("_u.output_tokens"), "total_tokens": num("_u.total_tokens"),
        "cached_tokens": num("_u.input_tokens_details.cached_tokens"), "cache_write_tokens": num("_u.input_tokens_details.cache_write_tokens"),
        "reasoning_tokens": num("_u.output_tokens_details.reasoning_tokens"), **{f"attributed_{k}": attributed(k) for k in ("input_tokens", "output_tokens", "cached_tokens", "cache_write_tokens")},
        "safety_buffering": c("_safety").isNotNull(), "safety_retry_model": F.when(kind.startswith("OBJECT"), X.present(F.get_json_object("_safety", "$.retry_model"))),
        "safety_use_cases": F.from_json(F.get_json_object("_safety", "$.use_cases"), "array<string>"), "safety_reasons": F.from_json(F.get_json_object("_safety", "$.reasons"), "array<string>"),
        "error_type": c("er.error.type"), "error_code": c("er.error.code"), "error_message": X.present(c("er.error.message")),
        "error_status": F.coalesce(c("er.status_code").try_cast("int"), c("er.status").try_cast("int")),
        "quota_resets_at": c("er.error.resets_at"), "quota_resets_in_seconds": c("er.error.resets_in_seconds"), "error_headers": X.lower_keys(c("er.headers")),
        "models_etag": X.lower_keys(c("me.headers"))["x-models-etag"], "turn_state": X.lower_keys(c("me.headers"))["x-codex-turn-state"],
        "routing_hint": F.when(c("cr").isNotNull() | c("cd").isNotNull() | c("co").isNotNull() | c("er").isNotNull(), X.routing_hint(c("_hint"), model)),
        "limit_allowed": c("rl.rate_limits.allowed"), "limit_reached": c("rl.rate_limits.limit_reached"),
        **{f"limit_{n}": c(f"rl.rate_limits.primary.{w}") for n, w in (("used", "used_percent"), ("minutes", "window_minutes"), ("reset", "reset_after_seconds"))},
        **{f"limit_secondary_{n}": c(f"rl.rate_limits.secondary.{w}") for n, w in (("used", "used_percent"), ("minutes", "window_minutes"), ("reset", "reset_after_seconds"))},
        "model_limits": c("rl.additional_rate_limits"), "has_credits": c("rl.credits.has_credits"), "credits_unlimited": c("rl.credits.unlimited"), "credits_balance": X.balance(c("rl.credits.balance")),
        "status": status,
    }
    own["plan_type"] = some(c("er.error.plan_type"), c("rl.plan_type"), own["error_headers"]["x-codex-plan-type"])
    own["thread_key"] = F.coalesce(own["thread_id"], F.concat(F.lit("session:"), own["session_id"]))
    own["cache_ratio"] = F.when(own["input_tokens"] > 0, own["cached_tokens"] / own["input_tokens"])
    kept = ("request_id", "instance", "frames", "bytes", "last_ts", "first_seq", "last_seq", "text_deltas", "tool_deltas", "close_code", "frame_errors", "transport_event", "tool_calls", "messages", "reasoning_bytes")
    return turns.select(*kept, *[v.alias(k) for k, v in own.items()])


def close_idle(turns: DataFrame, idle: str = "30 minutes") -> DataFrame:
    """Open turns that are idle against the capture's own clock, the latest frame anywhere."""
    now = turns.agg(F.max("last_ts").alias("now"))
    return turns.crossJoin(F.broadcast(now)).withColumn(  # one row
        "idle", (F.col("status") == "incomplete") & (F.col("last_ts") < F.col("now") - F.expr(f"interval {idle}"))
    ).drop("now")


#: The families that are named otherwise than by their header's prefix, and the headers of a failure that belong to no family.
FAMILIES = {"x-codex": "codex", "x-codex-bengalfox": "bengalfox", "x-base-model-inference": "base_model_inference"}
QUOTA_OWN = {"active_limit": "x-codex-active-limit", "has_credits": "x-codex-credits-has-credits", "unlimited": "x-codex-credits-unlimited", "balance": "x-codex-credits-balance"}
QUOTA_MEASURES = {"used": "used-percent", "minutes": "window-minutes", "reset_at": "reset-at", "reset": "reset-after-seconds"}


def quota_headers(rows: DataFrame, key: str, headers: str) -> DataFrame:
    """Pivot a failure's headers to ``(key, family, limit_name, over_percent, windows)``, a row for each family; an empty value is absent, "0" isn't.

    ``windows`` maps primary and secondary to their measures; rows without such headers, and null maps, give no row.
    """
    e = rows.select(key, F.explode(X.lower_keys(F.col(headers))).alias("name", "value")).where("value <> ''")
    found = "^(.+)-(limit-name|primary-over-secondary-limit-percent|(primary|secondary)-(used-percent|window-minutes|reset-at|reset-after-seconds))$"
    part = lambda i: F.regexp_extract("name", found, i)
    named = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    e = e.select(key, part(1).alias("prefix"), part(2).alias("field"), part(3).alias("window"), part(4).alias("measure"), "value").where("prefix <> ''")
    e = e.withColumn("family", F.coalesce(named[F.col("prefix")], F.replace(F.regexp_replace("prefix", "^x-", ""), F.lit("-"), F.lit("_"))))
    v = F.col("value").try_cast("double")
    measures = lambda w: F.struct(*[F.max(F.when((F.col("window") == w) & (F.col("measure") == m), v)).alias(n) for n, m in QUOTA_MEASURES.items()])
    out = e.groupBy(key, "family").agg(
        F.max(F.when(F.col("field") == "limit-name", F.col("value"))).alias("limit_name"),
        F.max(F.when(F.col("field") == "primary-over-secondary-limit-percent", v)).alias("over_percent"),
        *[F.when(F.count_if(F.col("window") == w) > 0, measures(w)).alias(w) for w in ("primary", "secondary")],
    )
    pairs = F.filter(F.array(*[F.struct(F.lit(w).alias("key"), F.col(w).alias("value")) for w in ("primary", "secondary")]), lambda p: p["value"].isNotNull())
    return out.select(key, "family", "limit_name", "over_percent", F.map_from_entries(pairs).alias("windows"))


def quota_windows(rows: DataFrame, key: str, headers: str) -> DataFrame:
    """``(key, family, window, used, minutes, reset_at, reset)``: a row for each window of :func:`quota_headers`."""
    out = quota_headers(rows, key, headers).select(key, "family", F.explode("windows").alias("window", "m"))
    return out.select(key, "family", "window", *[F.col(f"m.{n}").alias(n) for n in QUOTA_MEASURES])


def quota_failure(headers: Column) -> Column:
    """A failure's headers that belong to no family, as a struct; ``headers`` has lower-case names."""
    flag = lambda c: F.lower(c).try_cast("boolean")
    parts = {k: X.present(headers[h]) for k, h in QUOTA_OWN.items()}
    return F.struct(*[(flag(v) if k in ("has_credits", "unlimited") else v).alias(k) for k, v in parts.items()])


def model_limits(turns: DataFrame) -> DataFrame:
    """``(request_id, instance, account_id, model, allowed, limit_reached, window, used, minutes, reset)``: limits by model; windows without minutes are left out."""
    e = turns.select("request_id", "instance", "account_id", F.explode("model_limits").alias("model", "b")).where("b is not null")
    windows = F.array(*[F.struct(F.lit(w).alias("window"), F.col(f"b.{w}").alias("w")) for w in ("primary", "secondary")])
    e = e.select("*", F.explode_outer(F.filter(windows, lambda x: x["w"]["window_minutes"] > 0)).alias("x"))
    cells = (("used", "used_percent"), ("minutes", "window_minutes"), ("reset", "reset_after_seconds"))
    return e.select("request_id", "instance", "account_id", "model", "b.allowed", "b.limit_reached", "x.window", *[F.col(f"x.w.{w}").alias(n) for n, w in cells])


def rate_limits(frames: DataFrame) -> DataFrame:
    """``request_id, allowed, used, minutes, secondary_used, balance, unlimited`` of each request's last limits event."""
    df = segment(frames).where("ev_type = 'codex.rate_limits'")
    yes = F.lit(True)
    g = df.groupBy("request_id", "instance").agg(
        _last(_get("$.rate_limits.allowed", "boolean"), yes).alias("allowed"),
        _last(_get("$.rate_limits.primary.used_percent", "double"), yes).alias("used"),
        _last(_get("$.rate_limits.primary.window_minutes", "int"), yes).alias("minutes"),
        _last(_get("$.rate_limits.secondary.used_percent", "double"), yes).alias("secondary_used"),
        _last(_get("$.credits.balance"), yes).alias("_balance"),
        _last(_get("$.credits.unlimited", "boolean"), yes).alias("unlimited"),
    )
    return g.withColumn("balance", X.balance(F.col("_balance"))).drop("_balance")


def item_counts(frames: DataFrame) -> DataFrame:
    """``request_id, instance, items``: a map from output item type to how many a response has."""
    df = segment(frames).where("ev_type = 'response.output_item.done'")
    n = df.groupBy("request_id", "instance", _get("$.item.type").alias("t")).agg(F.count("*").alias("n")).where("t is not null")
    return n.groupBy("request_id", "instance").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n")))).alias("items"))
