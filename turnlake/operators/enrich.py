"""Joins of turns with request logs, accounts and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, keys: list[str], order: list[str], ok: str = "true") -> DataFrame:
    """The newest row of each key by an aggregation, without a sort."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.where(ok).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def attach(turns: DataFrame, logs: DataFrame, key: str, alias: str, log_key: str, log_alias: str, order: str, columns: list[str]) -> DataFrame:
    """Left join with the newest log of a turn's key, else of its alias, and ``outcome`` (hit or miss)."""
    pick = [F.col(c).alias(f"_1_{c}") for c in columns]
    first = newest(logs.select(log_key, order, *columns), [log_key], [order]).select(F.col(log_key).alias("_k"), F.lit(True).alias("_1"), *pick)
    second = newest(logs.select(log_alias, order, *columns), [log_alias], [order]).select(
        F.col(log_alias).alias("_a"), F.lit(True).alias("_2"), *[F.col(c).alias(f"_2_{c}") for c in columns]
    )
    df = turns.join(first, F.col(key) == F.col("_k"), "left").join(second, F.col(alias) == F.col("_a"), "left")
    out = [F.when(F.col("_1"), F.col(f"_1_{c}")).otherwise(F.col(f"_2_{c}")).alias(c) for c in columns]
    return df.select(*turns.columns, *out, F.when(F.coalesce("_1", "_2"), "hit").otherwise("miss").alias("outcome"))


def tier_outcome(requested, actual):
    return (
        F.when(F.coalesce(requested, F.lit("")) == "", "not_requested").when(F.coalesce(actual, F.lit("")) == "", "unknown")
        .when(requested == actual, "granted").otherwise("downgraded")
    )


def eligibility(accounts: DataFrame, keys: DataFrame, allowed: DataFrame, account: str, key: str) -> DataFrame:
    """Every active key with every account: eligible when the key has no account list, or the account is on it. Both sides are small
    dimensions that the question itself pairs."""
    scoped = allowed.select(F.col(key).alias("_k")).distinct().withColumn("scoped", F.lit(True))
    pairs = allowed.select(F.col(account).alias("_pa"), F.col(key).alias("_pk")).distinct().withColumn("listed", F.lit(True))
    every = keys.join(scoped, F.col(key) == F.col("_k"), "left").crossJoin(accounts)
    got = every.join(pairs, (F.col(account) == F.col("_pa")) & (F.col(key) == F.col("_pk")), "left")
    return got.select(account, key, (F.col("scoped").isNull() | F.col("listed").isNotNull()).alias("eligible"))


#: What a proxy's log adds to a turn: the turn's columns and the log's.
LOG_COLUMNS = {
    "cost_usd": "cost_usd", "wait_queue_ms": "queue_wait_ms", "wait_gate_ms": "gate_wait_ms", "wait_bridge_ms": "bridge_wait_ms", "latency_ms": "latency_ms", "latency_first_token_ms": "first_token_ms",
    "sticky_kind": "sticky_kind", "sticky_source": "sticky_source", "tier_actual": "actual_tier", "api_key": "api_key", "plan": "plan", "upstream_status": "upstream_status", "upstream_code": "upstream_code",
    "connection_kind": "connection_kind", "failure_phase": "failure_phase", "client_group": "client_group", "retries": "retries",
}


def attach_log(turns: DataFrame, logs: DataFrame) -> DataFrame:
    """The turns with what the newest log of their response says, else that of their request, ``tier_outcome`` and ``outcome`` (hit or miss).

    ``logs``: ``request_id, archive_id, id, deleted`` and the log's columns; deleted logs and null ids answer nothing. Of a response that
    several turns name, cost and waits go to the first one only.
    """
    kept = logs.where("not coalesce(deleted, false)").select("request_id", "archive_id", "id", *[F.col(c).alias(n) for n, c in LOG_COLUMNS.items()])
    kept = kept.withColumnsRenamed({"request_id": "log_request", "archive_id": "log_archive"})
    out = attach(turns, kept, "response_id", "request_id", "log_request", "log_archive", "id", list(LOG_COLUMNS))
    out = out.withColumn("tier_outcome", tier_outcome(F.col("tier_requested"), F.coalesce("tier_actual", "tier")))
    first = F.struct("request_id", "instance") == F.min(F.struct("request_id", "instance")).over(Window.partitionBy(F.coalesce("response_id", F.concat_ws(":", "request_id", "instance"))))
    once = ("cost_usd", "wait_queue_ms", "wait_gate_ms", "wait_bridge_ms")
    return out.withColumn("_first", first).withColumns({c: F.when(F.col("_first"), F.col(c)) for c in once}).drop("_first")


def outcomes(attached: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``outcome, n, share`` of the attached turns, in all or for each value of the keys."""
    keys = keys or []
    n = attached.groupBy(*keys, "outcome").agg(F.count("*").alias("n"))
    return n.withColumn("share", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def account_snapshot(accounts: DataFrame, usage: DataFrame) -> DataFrame:
    """``account_id, plan_type, window, used, reset, credits``: every known account's newest usage of each window and newest credits.

    ``usage``: ``account_id, window, recorded_at, used, reset, credits``; usage of unknown accounts is dropped, accounts without usage stay.
    """
    last = newest(usage.select("account_id", "window", "recorded_at", "used", "reset"), ["account_id", "window"], ["recorded_at"])
    money = newest(usage.select("account_id", "recorded_at", "credits"), ["account_id"], ["recorded_at"], "credits is not null").select("account_id", "credits")
    return accounts.select("account_id", "plan_type").join(last, "account_id", "left").join(money, "account_id", "left")
