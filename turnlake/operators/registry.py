"""The metrics that turns give, as a list to extend: what each is called, what it counts, when, and by which attributes."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.operators import metrics


@dataclass(frozen=True)
class Metric:
    """``value`` and ``when`` are SQL over the columns of ``table``; a metric is left out, with a warning, where a column of its is missing."""

    name: str
    kind: str  # counter, histogram or gauge
    value: str = "1"
    when: str = "true"
    labels: tuple[str, ...] = ("model",)
    bounds: tuple[float, ...] = ()
    table: str = "turns"


def _counter(name: str, value: str = "1", when: str = "true", *labels: str, table: str = "turns") -> Metric:
    return Metric(name, "counter", value, when, labels or ("model",), table=table)


def _timing(name: str, column: str, when: str | None = None, bounds: tuple[float, ...] = metrics.SECONDS_BOUNDS) -> Metric:
    return Metric(name, "histogram", f"{column} / 1000.0D", when or f"{column} > 0", ("model",), bounds)


def _gauge(name: str, column: str, *labels: str, table: str = "turns") -> Metric:
    return Metric(name, "gauge", f"cast({column} as double)", f"{column} is not null and account_id <> ''", ("account_id", *labels), table=table)


_TOKENS = ("input", "output", "cached", "reasoning", "cache_write")
_EXCLUSIVE = ("engine_inference", "engine_sampling", "api_inference", "api_sampling", "outside_engine_and_tools", "outside_wait_and_sampling", "outside_wait_and_sampling_api", "outside_client_tools")

METRICS: tuple[Metric, ...] = (
    _counter("responses", "1", "true", "model", "status"),
    _counter("turns", "1", "request_kind = 'turn'", "model", "status"),
    *[_counter(f"tokens_{t}", f"{t}_tokens", f"{t}_tokens > 0") for t in _TOKENS],
    *[Metric(f"token_usage_{t}", "histogram", f"cast({t}_tokens as double)", f"{t}_tokens > 0", ("model",), metrics.TOKEN_BOUNDS) for t in _TOKENS],
    _counter("cost_usd", "cost_usd", "cost_usd >= 0"),
    *[_timing(f"proxy_wait_{k}", f"wait_{k}_ms", f"wait_{k}_ms is not null") for k in ("queue", "gate", "bridge")],
    *[_counter(f"proxy_wait_{k}_present", f"if(wait_{k}_ms is null, 0, 1)") for k in ("queue", "gate", "bridge")],
    _counter("engine_calls", "engine_calls", "engine_calls > 0"),
    _counter("tool_calls", "tool_calls", "tool_calls > 0"),
    _counter("tool_calls_by_name", "1", "name <> ''", "name", table="tool_calls"),
    Metric("tool_calls_per_response", "histogram", "cast(tool_calls as double)", "model <> ''", ("model",), metrics.TOKEN_BOUNDS),
    _counter("web_searches", "web_searches", "web_searches > 0"),
    _counter("image_tokens", "image_tokens", "image_tokens > 0"),
    _counter("errors", "1", "status = 'error'", "model", "error_type"),
    _counter("transport_events", "1", "status = 'transport' or close_code is not null or frame_errors > 0", "close_code"),
    _counter("safety_buffering", "1", "safety_buffering"),
    _counter("baseline_resets", "1", "baseline_reset"),
    _timing("operation_duration", "(completed_ms - created_ms)", "completed_ms >= created_ms"),
    _timing("turn_duration", "(completed_ms - client_start_ms)", "request_kind = 'turn' and completed_ms >= client_start_ms"),
    _timing("time_to_first_token", "first_token_ms"),
    *[_timing(f"critical_path_{k}", f"critical_{k}_ms") for k in ("engine", "unblocked", "sampling", "pre_inference", "tool_pause")],
    *[_timing(k, f"delta_{k}_ms") for k in _EXCLUSIVE],
    _counter("uncached_prompt_tokens", "delta_uncached_tokens", "delta_uncached_tokens > 0"),
    *[_timing(f"time_between_tokens_{k}", f"tbt_{k}_ms") for k in ("engine", "api")],
    _timing("time_between_tokens_gap", "tbt_gap_ms", "tbt_gap_ms <> 0", metrics.SIGNED_SECONDS_BOUNDS),
    _gauge("limit_used", "limit_used", "window"), _gauge("limit_reset", "limit_reset", "window"), _gauge("limit_secondary_used", "limit_secondary_used"),
    _gauge("model_limit_used", "used", "model", "minutes", table="model_limits"), _gauge("credits_balance", "credits_balance"), _gauge("credits_unlimited", "credits_unlimited"),
    _gauge("limit_reached", "limit_reached"), _gauge("model_limit_reached", "limit_reached", "model", table="model_limits"),
    _counter("quota_failures", "1", "account_id <> '' and quota_families > 0", "account_id"),
    _gauge("quota_failure_used", "used", "family", "window", table="quota"), _gauge("quota_failure_reset", "reset", "family", "window", table="quota"),
    _counter("routing_hints", "1", "routing_hint <> ''", "routing_hint"),
    _counter("content_items", "n", "n > 0", "kind", table="kinds"),
    _counter("compactions", "1", "compaction_trigger <> ''", "compaction_trigger"),
    _counter("tier_outcomes", "1", "tier_outcome <> ''", "tier_outcome"),
    _counter("sticky_routing", "1", "sticky_kind <> '' and sticky_source <> ''", "sticky_kind", "sticky_source"),
    _timing("proxy_latency", "latency_ms"), _timing("proxy_first_token", "latency_first_token_ms"),
    _gauge("account_quota_used", "used", "window", table="accounts"), _gauge("account_quota_reset", "reset", "window", table="accounts"), _gauge("account_model_quota_used", "used", "quota_key", table="account_models"),
    _gauge("account_credits", "credits", table="accounts"), _gauge("account_info", "1", "plan_type", table="accounts"), _gauge("key_eligible", "eligible", "api_key", table="keys"),
    _counter("attributes_rejected", "rejected", "rejected > 0", "field", table="caps"),
)


_SQL_WORDS = frozenset("and or is not null cast as double if true d".split())


def missing(columns: Iterable[str], registry: Iterable[Metric] = METRICS) -> dict[str, list[str]]:
    """The metrics of turns that a table with these columns can't give, each with the columns it lacks; text literals are no names."""
    return _missing(columns, [m for m in registry if m.table == "turns"])


def _missing(columns: Iterable[str], registry: Iterable[Metric]) -> dict[str, list[str]]:
    found = {}
    for m in registry:
        named = re.findall(r"[a-z_][a-z_0-9]*", re.sub(r"'[^']*'", "", f"{m.value} {m.when}").lower())
        if lacks := sorted({*named, *m.labels} - _SQL_WORDS - set(columns)):
            found[m.name] = lacks
    return found


def points(turns: DataFrame, ts: str, order: list[str], registry: Iterable[Metric] = METRICS, table: str = "turns") -> DataFrame:
    """``(metric, kind, ts, seq, attrs, value, labels)``: one row for each metric that a turn has a value for, in a single pass over the turns.
    ``labels`` is the stable text of ``attrs``.

    ``table`` names what the rows are, turns or one of their child tables. Warns of the metrics that the columns can't give, and names those that
    are missing. Null and not-a-number values are no points; labels without a value are left out; rows of equal order are all counted.
    """
    registry, cells = [m for m in registry if m.table == table], []
    skipped = _missing(turns.columns, registry)
    if skipped:
        warnings.warn(f"{len(skipped)} of {len(registry)} metrics are left out: " + "; ".join(f"{k} lacks {', '.join(v)}" for k, v in skipped.items()), stacklevel=2)
    for m in (m for m in registry if m.name not in skipped):
        names = sorted(m.labels)
        text = F.concat_ws(",", *[F.when(F.col(k).cast("string") != "", F.concat(F.lit(f"{k}="), F.col(k).cast("string"))) for k in names])
        values = F.array(*[F.col(k).cast("string") for k in names])
        cell = F.struct(F.lit(m.name).alias("metric"), F.lit(m.kind).alias("kind"), F.array(*[F.lit(k) for k in names]).alias("names"), values.alias("values"), text.alias("labels"), F.expr(m.value).cast("double").alias("value"))
        cells.append(F.when(F.expr(m.when), cell))
    rows = turns.select(F.col(ts).alias("ts"), F.struct(*order).alias("seq"), F.explode(F.array(*cells)).alias("p"))  # nulls go in the next step, where no lambda keeps the cells from being compiled
    some = F.map_filter(F.map_from_arrays("p.names", "p.values"), lambda k, v: v.isNotNull() & (v != ""))
    return rows.where("p.value is not null and not isnan(p.value)").select("p.metric", "p.kind", "ts", "seq", some.alias("attrs"), "p.value", "p.labels")


def all_points(tables: dict[str, DataFrame], ts: str, order: list[str], registry: Iterable[Metric] = METRICS) -> DataFrame:
    """The points of turns and their child tables in one table; each is read once."""
    registry, out = list(registry), None
    for name, df in tables.items():
        rows = points(df, ts, order, registry, name)
        out = rows if out is None else out.unionByName(rows)
    return out


def aggregate(rows: DataFrame, registry: Iterable[Metric] = METRICS) -> DataFrame:
    """``(metric, kind, labels, value, count, buckets)``: counters add, histograms bucket, gauges keep the last value.

    Sums and buckets are counted by hashing; only gauges' points, whose last one is by a row's place, are sorted. Rows are read once for each.
    """
    bounds = {m.name: tuple(map(float, m.bounds)) for m in registry if m.bounds}
    within = F.lit(0)
    for b in set(bounds.values()):
        above = sum((F.col("value") > v).cast("int") for v in b)
        within = F.when(F.col("metric").isin([k for k, own in bounds.items() if own == b]), above).otherwise(within)
    key = ["metric", "kind", "labels"]
    keyed = rows if "labels" in rows.columns else rows.withColumn("labels", metrics.stable(F.col("attrs")))
    parts = keyed.where("kind <> 'gauge'").groupBy(*key, F.when(F.col("kind") == "histogram", within).alias("_b")).agg(F.sum("value").alias("_s"), F.count("*").alias("_n"))
    most = max(map(len, bounds.values()), default=0) + 1
    size = F.lit(1)
    for n in {len(b) for b in bounds.values()}:
        size = F.when(F.col("metric").isin([k for k, own in bounds.items() if len(own) == n]), n + 1).otherwise(size)
    cells = F.array(*[F.sum(F.when(F.col("_b") == i, F.col("_n")).otherwise(0)) for i in range(most)])
    sums = parts.groupBy(*key).agg(F.sum("_s").alias("value"), F.sum("_n").alias("count"), cells.alias("_c"))
    sums = sums.select(*key, "value", "count", F.when(F.col("kind") == "histogram", F.slice("_c", F.lit(1), size)).alias("buckets"))
    last = keyed.where("kind = 'gauge'").groupBy(*key).agg(F.max_by("value", "seq").alias("value"), F.count("*").alias("count"))
    return sums.unionByName(last.withColumn("buckets", F.lit(None).cast(sums.schema["buckets"].dataType)))


def series_counts(rows: DataFrame, registry: Iterable[Metric] = METRICS) -> DataFrame:
    """How many stored series each metric makes: its attribute sets, times the buckets, sum and count of a histogram."""
    times = {m.name: len(m.bounds) + 3 if m.kind == "histogram" else 1 for m in registry}
    factor = F.create_map(*[x for k, n in times.items() for x in (F.lit(k), F.lit(n))])
    n = rows.groupBy("metric").agg(F.countDistinct(metrics.stable(F.col("attrs"))).alias("sets"))
    return n.select("metric", "sets", (F.col("sets") * factor[F.col("metric")]).alias("series"))
