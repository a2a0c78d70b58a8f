"""Attributes with bounded cardinality, metric points, and the queries that dashboards and alerts ask of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bucket bounds (a value equal to a bound falls in its bucket).
_NEAR_ZERO = (0.001, 0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 1.0, 5.0, 10.0)
SECONDS_BOUNDS = tuple(0.01 * 2**k for k in range(14))
SIGNED_SECONDS_BOUNDS = (*(-b for b in reversed(_NEAR_ZERO)), 0.0, *_NEAR_ZERO)
TOKEN_BOUNDS = tuple(float(4**k) for k in range(14))


def attributes(**fields: Column) -> Column:
    """A map of the fields that are present."""
    pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in fields]), F.array(*[c.cast("string") for c in fields.values()]))
    return F.map_filter(pairs, lambda k, v: v.isNotNull() & (v != ""))


def only(attrs: Column, keys: list[str]) -> Column:
    return F.map_filter(attrs, lambda k, v: k.isin(keys))


def stable(attrs: Column) -> Column:
    """A map's sorted ``key=value`` text, to group by."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(attrs)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def cap_values(rows: DataFrame, field: str, order: list[str], cap: int) -> DataFrame:
    """Keep a field's first ``cap`` distinct values in order of arrival; others become ``_other``. At most ``cap`` values are broadcast."""
    first = rows.where(F.col(field) != "").groupBy(field).agg(F.min(F.struct(*order)).alias("o"))
    kept = first.orderBy("o").limit(cap).select(F.col(field).alias("_v"))
    out = rows.join(F.broadcast(kept), F.col(field) == F.col("_v"), "left")
    value = F.when(F.coalesce(F.col(field), F.lit("")) == "", F.col(field)).otherwise(F.coalesce("_v", F.lit("_other")))
    return out.withColumn(field, value).drop("_v")


def cap_report(rows: DataFrame, field: str, order: list[str], cap: int) -> DataFrame:
    """``field, distinct, rejected``: how many values were let through, no more than ``cap``, and how many rows :func:`cap_values` rewrote."""
    values = rows.where(F.col(field) != "").groupBy(field).agg(F.min(F.struct(*order)).alias("o"), F.count("*").alias("n"))
    kept = values.orderBy("o").limit(cap).agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))
    total = values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    return kept.crossJoin(total).select(F.lit(field).alias("field"), "distinct", (F.col("total") - F.col("kept")).alias("rejected"))  # one row each


def bucket_of(value: Column, bounds: tuple[float, ...]) -> Column:
    """Index of the first bound that is not below the value; the number of bounds for what exceeds all."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < value))


def histogram(rows: DataFrame, keys: list[str], value: Column, bounds: tuple[float, ...]) -> DataFrame:
    """``keys, count, sum, buckets``: counts of values for each bound and beyond the last."""
    b = rows.where(value.isNotNull()).withColumn("_v", value).withColumn("_b", bucket_of(F.col("_v"), bounds))
    cells = [F.count_if(F.col("_b") == i) for i in range(len(bounds) + 1)]
    return b.groupBy(*keys).agg(F.count("*").alias("count"), F.sum("_v").alias("sum"), F.array(*cells).alias("buckets"))


def quantile(buckets: Column, bounds: tuple[float, ...], q: float) -> Column:
    """A quantile by linear interpolation in its bucket; values beyond the last bound count as that bound."""
    total = F.aggregate(buckets, F.lit(0).cast("long"), lambda a, x: a + x)
    rank = total * q
    edges = F.array(F.lit(0.0), *[F.lit(b) for b in bounds], F.lit(bounds[-1]))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).alias("i"), F.lit(None).cast("double").alias("at"))

    def step(acc: Column, n: Column) -> Column:
        now = acc["seen"] + n
        low, high = F.get(edges, acc["i"]), F.get(edges, acc["i"] + 1)
        inside = low + (high - low) * (rank - acc["seen"]) / F.when(n > 0, n)
        here = acc["at"].isNull() & (n > 0) & (now >= rank)
        return F.struct(now.alias("seen"), (acc["i"] + 1).alias("i"), F.when(here, inside).otherwise(acc["at"]).alias("at"))

    return F.when(total > 0, F.aggregate(buckets, start, step)["at"])


def rate(rows: DataFrame, ts: str, step: str, seconds: int, keys: list[str], value: Column | None = None) -> DataFrame:
    """``step, keys, rate``: sums (or counts) for each step, per second."""
    total = F.count("*") if value is None else F.sum(value)
    return rows.groupBy(F.window(ts, step).start.alias("step"), *keys).agg((total / seconds).alias("rate"))


def last_value(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def top(rows: DataFrame, by: str, n: int, ties: list[str]) -> DataFrame:
    return rows.orderBy(F.desc(by), *ties).limit(n)


def share_of_step(rows: DataFrame, step: str, value: str) -> DataFrame:
    return rows.withColumn("share", 100.0 * F.col(value) / F.sum(value).over(Window.partitionBy(step)))


def breaches(points: DataFrame, keys: list[str], step: str, seconds: int, value: str, above: float, hold: int) -> DataFrame:
    """Alert intervals: runs of consecutive steps above a threshold that last at least ``hold`` steps."""
    w = Window.partitionBy(*keys).orderBy(step)
    hot = points.where(F.col(value) > above)
    island = F.col(step).cast("long") / seconds - F.row_number().over(w)
    runs = hot.withColumn("_i", island).groupBy(*keys, "_i").agg(F.min(step).alias("begin"), F.max(step).alias("last"), F.count("*").alias("steps"))
    return runs.where(F.col("steps") >= hold).drop("_i")


def label_matches(c: Column, pattern: str) -> Column:
    """A label filter: the whole value matches; a missing label is an empty one."""
    return F.regexp_like(F.coalesce(c, F.lit("")), F.lit(f"^(?:{pattern})$"))


def error_category(kind: Column, code: Column) -> Column:
    """A bounded category from an error's type and code."""
    text = F.lower(F.concat_ws(" ", kind, code))
    rules = {"rate_limit": "rate|quota|limit|429", "auth": "auth|401|403|forbidden", "timeout": "timeout|deadline|504", "server": "server|overload|5[0-9][0-9]", "invalid": "invalid|400|not_found|404"}
    out = F.when(text == "", None)
    for name, pattern in rules.items():
        out = out.when(F.regexp_like(text, F.lit(pattern)), name)
    return out.otherwise("other")


#: The names of an agent and of one that another spawned, and the only category of errors.
AGENT, SUBAGENT, SDK_ERROR = "codex", "codex/subagent", "sdk_error"


def failure(status: Column, error_type: Column, error_code: Column) -> Column:
    """The category of a response that failed, or says an error; null for others."""
    said = (F.coalesce(error_type, F.lit("")) != "") | (F.coalesce(error_code, F.lit("")) != "")
    return F.when((status == "error") | said, F.lit(SDK_ERROR))


def frame_class(errors: Column, close_code: Column) -> Column:
    """What a connection's end was: an error wins over a close; null while it is open."""
    return F.when(errors > 0, "error").when(close_code.isNotNull(), "close")


def agent_identity(thread_source: Column) -> Column:
    return F.when(thread_source == "subagent", SUBAGENT).otherwise(AGENT)


def quota_names(active: Column, headers: Column) -> Column:
    """The names of the limits of a quota failure, sorted and joined: the active one, and all that its headers (lower-case) name. Empty without any."""
    named = F.map_values(F.map_filter(headers, lambda k, v: F.endswith(k, F.lit("-limit-name"))))
    every = F.concat(F.array(active), F.coalesce(named, F.array().cast("array<string>")))
    return F.array_join(F.array_sort(F.filter(every, lambda x: x.isNotNull() & (x != ""))), ",")


def response_model(retry: Column, model: Column) -> Column:
    """The model that answered: a retry's wins."""
    return F.coalesce(F.nullif(retry, F.lit("")), model)


#: What a turn's fields are to those that store them: bounded ones make series and labels, identities may only be kept beside a record.
BOUNDED = (
    "model", "status", "request_kind", "thread_source", "family", "effort", "reasoning_mode", "verbosity", "tier", "tier_requested", "tier_outcome", "plan_type", "originator", "client_version", "error_type", "routing_hint",
    "compaction_trigger", "subagent_kind", "sandbox", "api_key", "client_group", "connection_kind", "failure_phase", "sticky_kind", "sticky_source", "cache_mode", "cache_diagnostic",
)
IDENTITY = ("request_id", "response_id", "thread_id", "session_id", "turn_id", "root_turn_id", "parent_thread_id", "parent_turn_id", "account_id", "installation_id", "window_id", "agent_name", "workspaces", "safety_id", "prompt_cache_key")
#: Labels of a log stream, of the bounded fields.
PROMOTED = ("family", "model", "request_kind", "status")


def bounded_attributes(columns: list[str]) -> Column:
    """The bounded fields that are present, with the provider and the operation, which depends on whether text was streamed."""
    streamed = [c for c in ("text_delta_count", "text_deltas") if c in columns]
    operation = F.when(F.coalesce(*streamed) > 0, "streamText").otherwise("generateText") if streamed else F.lit("generateText")
    return attributes(**{c: F.col(c) for c in BOUNDED if c in columns}, provider=F.lit("openai"), operation=operation)


def span_attributes(columns: list[str]) -> Column:
    """Bounded fields and identities that are present."""
    return F.map_concat(bounded_attributes(columns), attributes(**{c: F.col(c) for c in IDENTITY if c in columns}))


def stream_labels(columns: list[str], record: Column, promoted: tuple[str, ...] = PROMOTED) -> Column:
    """Labels of a log stream: promoted bounded fields and the type of record, sorted by name; a field that isn't bounded is refused."""
    if odd := [p for p in promoted if p not in BOUNDED]:
        raise ValueError(f"labels must be bounded fields: {odd}")
    return F.map_from_entries(F.array_sort(F.map_entries(attributes(record_type=record, **{c: F.col(c) for c in promoted if c in columns}))))


def log_metadata(columns: list[str], promoted: tuple[str, ...] = PROMOTED) -> Column:
    """All fields of a log record that are no labels, identities among them."""
    return F.map_filter(span_attributes(columns), lambda k, v: ~k.isin(*promoted))


def guarded(attrs: Column, extra: Column, allowed: tuple[str, ...]) -> Column:
    """``(attrs, rejected)``: the attributes with those extra ones that are allowed, which go before; and how many aren't. Null maps add nothing."""
    given = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    good = F.map_filter(given, lambda k, v: k.isin(*allowed) & (v != ""))
    own = F.map_filter(attrs, lambda k, v: ~F.map_contains_key(good, k))
    return F.struct(F.map_concat(own, good).alias("attrs"), F.size(F.map_filter(given, lambda k, v: ~k.isin(*allowed))).alias("rejected"))


def sanitised(attrs: Column) -> Column:
    """Label names with underscores for dots; of names that become one, the first in order of name counts."""
    pairs = F.array_sort(F.map_entries(attrs))
    names = F.transform(pairs, lambda e: F.replace(e["key"], F.lit("."), F.lit("_")))
    first = F.filter(F.transform(pairs, lambda e, i: F.struct(F.get(names, i).alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: F.array_position(names, e["key"]) == e["i"] + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"], e["value"])))
