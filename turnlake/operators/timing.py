"""A response's timing: cumulative counters and what one response adds to them, readings of one response, and its critical path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import deltas
from turnlake.operators.turns import ORDER, segment

#: The cumulative counters of a series and their names on the wire.
COUNTERS = {
    "calls": "num_engine_calls", "turn_seconds": "total_turn_time_s", "sampled_tokens": "num_sampled_tokens_total", "prompt_tokens": "engine_total_prompt_tokens_total",
    "cached_prompt_tokens": "engine_cached_prompt_tokens_total", "uncached_tokens": "engine_uncached_prompt_tokens_total", "tool_pause_ms": "client_tool_pause_total_ms",
    "engine_inference_ms": "engine_service_inference_total_ms", "engine_sampling_ms": "engine_service_sampling_total_ms",
    "api_inference_ms": "engine_iapi_inference_total_ms", "api_sampling_ms": "engine_iapi_sampling_total_ms",
    "outside_engine_and_tools_ms": "responses_duration_excl_engine_and_client_tool_time_ms", "outside_wait_and_sampling_ms": "responses_duration_excl_engine_wait_and_sampling_ms",
    "outside_wait_and_sampling_api_ms": "responses_duration_excl_engine_wait_and_sampling_iapi_ms", "outside_client_tools_ms": "responsesapi_duration_excl_client_tools_ms",
}
#: Readings that stand for themselves, averages among them, and must never be diffed.
READINGS = {
    "pre_inference_ms": "pre_inference_ms", "first_token_ms": "first_sampled_message_ttft_ms", "first_message_reasoning": "first_sampled_message_reasoning_tokens",
    "engine_queue_max_ms": "engine_queue_max_ms", "engine_total_ms": "engine_service_total_ms", "engine_first_token_ms": "engine_service_ttft_total_ms",
    "api_first_token_ms": "engine_iapi_ttft_total_ms", "text_delta_count": "websocket_output_text_delta_count", "text_delta_gap_ms": "websocket_output_text_delta_tbt_ms",
    "pauses": "responses_duration_pause_count", "tbt_engine_ms": "engine_service_tbt_across_engine_calls_ms", "tbt_api_ms": "engine_iapi_tbt_across_engine_calls_ms",
    "tbt_gap_ms": "engine_service_minus_iapi_tbt_across_engine_calls_ms",
}
#: The server's own account of one response.
CRITICAL = {
    "calls": "num_engine_calls", "engine_ms": "engine_wall_ms", "api_ms": "engine_iapi_total_ms", "unblocked_ms": "responses_harness_unblocked_ms",
    "pre_inference_ms": "responses_pre_inference_ms", "sampling_ms": "sampling_and_stream_total_ms", "tool_pause_ms": "client_tool_pause_ms", "other_ms": "responses_other_ms",
}
_ARRAY, _CUT, _ENGINES = "responsesapi_duration_excl_engine_per_tool_call_ms", "responsesapi_duration_excl_engine_per_tool_call_truncated", "engine_ids"
_SCHEMA = (
    "timing_metrics struct<" + ", ".join(f"{w}: double" for w in (*COUNTERS.values(), *READINGS.values()))
    + f", {_ARRAY}: array<double>, {_CUT}: boolean, {_ENGINES}: string, timing_scope: string, critical_path: struct<scope: string, coverage: string, boundary_type: string, "
    + ", ".join(f"{w}: double" for w in CRITICAL.values()) + ">>"
)


def timings(frames: DataFrame) -> DataFrame:
    """``request_id, instance, timing_seq, timing_ts`` and every counter and reading: a response's last value of each that isn't null.

    ``critical`` is the last critical path, null without one. Responses without a timing event have no row.
    """
    df = segment(frames).where("ev_type = 'responsesapi.websocket_timing' and event is not null")
    df = df.withColumn("_t", F.from_json("event", _SCHEMA)["timing_metrics"])
    seq = F.struct(*ORDER)
    last = lambda c: F.max_by(c, F.when(c.isNotNull(), seq))
    field = lambda w: F.col(f"_t.{w}")
    path = F.struct(field("critical_path.coverage").alias("coverage"), field("critical_path.boundary_type").alias("boundary"), *[field(f"critical_path.{w}").alias(n) for n, w in CRITICAL.items()])
    critical = F.when(field("critical_path").isNotNull(), path)
    values = {**{n: field(w) for n, w in (COUNTERS | READINGS).items()}, "tool_ms": field(_ARRAY), "tool_ms_cut": field(_CUT), "engines": field(_ENGINES), "scope": field("timing_scope"), "critical": critical}
    return df.groupBy("request_id", "instance").agg(F.max(seq).alias("timing_seq"), F.max_by("ts", seq).alias("timing_ts"), *[last(v).alias(n) for n, v in values.items()])


def complete(turns: DataFrame, readings: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The turns with their readings, what each response adds to the counters (``delta_*``, ``new_tool_ms``), and ``logical_turn``.

    A series is a thread's responses of one kind: kinds run beside each other, each with counters of its own. Responses without a timing event
    have no deltas and are no baseline. The logical turn is the server's id, or the thread and a number that grows with every reset, and with
    every response that has neither timing nor id. Null threads and kinds are a series of their own.
    """
    joined = turns.join(readings, ["request_id", "instance"], "left").withColumn("_timed", F.col("timing_seq").isNotNull())
    timed = joined.where("_timed").withColumns({"_thread": F.coalesce("thread_id", F.lit("")), "_kind": F.coalesce("request_kind", F.lit(""))})
    out = deltas.counter_deltas(timed, ["_thread", "_kind"], ["timing_seq"], "calls", list(COUNTERS), "first_ts", "timing_ts", gap, array="tool_ms")
    rest = joined.where("not _timed")
    all_ = out.drop("_thread", "_kind").unionByName(rest, allowMissingColumns=True)
    grows = F.when(F.col("_timed"), F.col("reset")).otherwise(F.col("turn_id").isNull())
    all_ = all_.withColumns({"_order": F.coalesce("timing_seq", "last_seq"), "_grows": grows, "_t": F.coalesce("thread_id", F.lit(""))})
    return deltas.logical_turns(all_, "_t", ["_order", "request_id", "instance"], "_grows", "turn_id").drop("_order", "_grows", "_t", "_timed")


def measures(turns: DataFrame) -> DataFrame:
    """The columns that the metric registry reads of a complete turn; where the server gives a critical path, it goes before the counters."""
    measured = F.coalesce(X.present(F.col("critical.coverage")), F.lit("")) != ""
    ms = lambda c: F.unix_millis(c)
    quota = F.size(F.filter(F.map_keys("error_headers"), lambda k: F.regexp_like(k, F.lit("-(limit-name|(primary|secondary)-[a-z-]+)$"))))
    return turns.withColumns({
        "engine_calls": F.when(measured, F.col("critical.calls")).otherwise(F.col("delta_calls")),
        "created_ms": ms(F.col("server_created")), "completed_ms": ms(F.col("server_completed")), "client_start_ms": ms(F.col("turn_start")),
        **{f"critical_{k}_ms": F.col(f"critical.{k}_ms") for k in ("engine", "unblocked", "sampling")},
        "critical_pre_inference_ms": F.when(measured, F.col("critical.pre_inference_ms")).otherwise(F.col("pre_inference_ms")),
        "critical_tool_pause_ms": F.when(measured, F.col("critical.tool_pause_ms")).otherwise(F.col("delta_tool_pause_ms")),
        "window": F.when(F.col("limit_minutes") > 0, F.col("limit_minutes").cast("string")), "limit_used": F.when(F.col("limit_minutes") > 0, F.col("limit_used")),
        "limit_reset": F.when(F.col("limit_minutes") > 0, F.col("limit_reset")), "limit_secondary_used": F.when(F.col("limit_secondary_minutes") > 0, F.col("limit_secondary_used")),
        "limit_reached": F.when((F.col("limit_minutes") > 0) | (F.col("limit_secondary_minutes") > 0), F.coalesce("limit_reached", F.lit(False))),
        "credits_unlimited": F.when(F.col("has_credits") | F.col("credits_unlimited") | F.col("credits_balance").isNotNull(), F.col("credits_unlimited")),
        "quota_families": F.coalesce(F.greatest(quota, F.lit(0)), F.lit(0)),
    })
