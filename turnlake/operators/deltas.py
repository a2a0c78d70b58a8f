"""Cumulative readings to per-response amounts, as window expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counter_deltas(
    rows: DataFrame, series: list[str], order: list[str], calls: str, counters: list[str], first_ts: str, last_ts: str, gap: str, array: str | None = None
) -> DataFrame:
    """Add ``delta_<counter>``, ``reset``, ``baseline_reset`` and, for an array, ``new_<array>``.

    A reading is diffed against the one before in its series. It counts in full (a reset) without one, after a gap between the last
    reading's ``last_ts`` and this one's ``first_ts``, or when the call count didn't grow. Rows whose call count is null count in full and
    don't become a baseline. A growing array gives the entries past the last array's length since the reset; a shorter one is taken whole.
    """
    w = Window.partitionBy(*series).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    has = F.col(calls).isNotNull()
    past = lambda c: F.last(F.when(has, c), True).over(before)
    df = rows.withColumns({"_calls": past(F.col(calls)), "_ts": past(F.col(last_ts)), **{f"_p_{c}": past(F.coalesce(F.col(c), F.lit(0))) for c in counters}})
    cold = F.col("_calls").isNull() | F.coalesce(F.col(first_ts) - F.col("_ts") > F.expr(f"interval {gap}"), F.lit(False))
    reset = cold | ~has | (F.col(calls) <= F.col("_calls"))
    df = df.withColumns({"baseline_reset": cold, "reset": reset})
    for c in counters:
        df = df.withColumn(f"delta_{c}", F.coalesce(F.col(c), F.lit(0)) - F.when(F.col("reset"), 0).otherwise(F.col(f"_p_{c}")))
    if array:
        part = F.sum(F.when(has & F.col("reset"), 1).otherwise(0)).over(w)
        df = df.withColumn("_part", F.coalesce(part, F.lit(0)))
        inner = Window.partitionBy(*series, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        base = F.when(~F.col("reset"), F.last(F.when(has, F.col(array)), True).over(inner))
        df = df.withColumn("_base", base)
        whole = F.col("_base").isNull() | (F.size("_base") > F.size(array))
        tail = F.slice(array, F.size("_base") + 1, F.greatest(F.size(array) - F.size("_base"), F.lit(0)))
        df = df.withColumn(f"new_{array}", F.when(whole, F.col(array)).otherwise(tail))
        df = df.withColumn(f"new_{array}", F.when(F.size(f"new_{array}") > 0, F.col(f"new_{array}"))).drop("_base", "_part")
    return df.drop("_calls", "_ts", *[f"_p_{c}" for c in counters])


def logical_turns(rows: DataFrame, thread: str, order: list[str], reset: str, server_turn: str) -> DataFrame:
    """Add ``logical_turn``: the server's id, or the thread with a number that grows at each reset."""
    n = F.sum(F.when(F.col(reset), 1).otherwise(0)).over(Window.partitionBy(thread).orderBy(*order))
    return rows.withColumn("logical_turn", F.coalesce(F.nullif(F.col(server_turn), F.lit("")), F.concat_ws(":", F.col(thread).cast("string"), n.cast("string"))))


def live_baselines(baselines: DataFrame, thread: str, last_ts: str, cutoff, open_threads: DataFrame) -> DataFrame:
    """Baselines that stay: newer than the cutoff, or of a thread with an open response."""
    kept = baselines.where(F.col(last_ts) >= cutoff)
    old = baselines.where(F.col(last_ts) < cutoff)
    return kept.unionByName(old.join(open_threads.select(thread).distinct(), thread, "left_semi").select(*baselines.columns))
