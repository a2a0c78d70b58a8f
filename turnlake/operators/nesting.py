"""Structural search in trees of spans: which spans are under, over or beside others, by intervals instead of pairs or climbs.

Every span of a trace is numbered as a walk meets it, parents first, siblings by start and id. A span's ``enter`` is its number, its ``leave`` the
number of the last span under it: so one is under another when its ``enter`` lies behind the other's and not behind its ``leave``. Tests on
intervals that nest need no pairs: a running maximum of ``leave`` answers "under", a running count "over".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.operators.threads import climb
from turnlake.sources.tables import checkpointed, discard


def before(rows: DataFrame, keys: list[str], order: list[str], value: Column, name: str, fold=F.sum) -> DataFrame:
    """Add what the rows before this one, in its key, come to; null before the first. ``order`` must be total in a key, and keys aren't null.

    Rows are sorted over all tasks, and each task starts from what the tasks before it hold of a key: a key of many rows is spread like others.
    """
    spread = rows.withColumn("_v", value).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = checkpointed(spread.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    inside = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that has the key
    parts = placed.groupBy(*keys, "_part").agg(fold("_v").alias("_all")).withColumn("_ahead", fold("_all").over(ahead)).drop("_all")
    both = placed.withColumn("_inside", fold("_v").over(inside)).join(parts, [*keys, "_part"])
    total = F.greatest("_ahead", "_inside") if fold is F.max else F.coalesce(F.col("_ahead") + F.col("_inside"), "_ahead", "_inside")
    return both.select(*rows.columns, total.alias(name))


def intervals(spans: DataFrame) -> DataFrame:
    """One row a span, with ``parent`` (null for a root), ``depth``, ``enter`` and ``leave``.

    A span whose parent isn't in its trace is a root, and a trace may have several. Of several rows of a span the one that starts first counts.
    Spans without an id or a trace, or on or under a cycle, have no place in a tree and are left out. Rounds are the logarithm of the depth.
    """
    node = lambda c: F.concat("trace_id", F.lit("\x1f"), F.col(c))
    kept = spans.where("trace_id is not null and span_id is not null").groupBy("trace_id", "span_id")
    kept = kept.agg(F.min_by(F.struct(*spans.columns), F.struct("start", "end", "name", "parent_span_id")).alias("_row")).select("_row.*")
    rows = checkpointed(kept.withColumns({"_node": node("span_id"), "_over": node("parent_span_id")}))
    tree = climb(rows, "_node", "_over").where("depth is not null").select(F.col("node").alias("_node"), "depth", F.col("descendants").alias("_below"))
    placed = rows.join(tree, "_node").withColumn("_over", F.when(F.col("depth") > 0, F.col("_over")).otherwise(F.col("trace_id")))
    placed = checkpointed(before(placed, ["_over"], ["start", "span_id"], F.col("_below") + 1, "_left"))
    discard(rows)
    top, left = F.col("depth") == 0, F.coalesce("_left", F.lit(0))
    state = checkpointed(placed.select("_node", F.when(top, F.col("_node")).otherwise(F.col("_over")).alias("_up"), F.when(top, 0).otherwise(left + 1).alias("_sum")))
    deepest, reach = placed.agg(F.max("depth")).first()[0] or 0, 1
    while reach < deepest:  # each round adds what stands before as many ancestors again; before a root stands nothing yet
        ahead = state.select(F.col("_node").alias("_up"), F.col("_up").alias("_next"), F.col("_sum").alias("_more"))
        last, state, reach = state, checkpointed(state.join(ahead, "_up").select("_node", F.col("_next").alias("_up"), (F.col("_sum") + F.col("_more")).alias("_sum"))), reach * 2
        discard(last)
    roots = placed.where(top).select(F.col("_node").alias("_up"), left.alias("_root"))
    entered = state.join(roots, "_up").select("_node", (F.col("_sum") + F.col("_root")).alias("enter"))
    parent = F.when(F.col("depth") > 0, F.col("parent_span_id")).alias("parent")
    return placed.join(entered, "_node").select(*spans.columns, parent, "depth", "enter", (F.col("enter") + F.col("_below")).alias("leave"))


def under(labelled: DataFrame, outer: Column, inner: Column) -> DataFrame:
    """Spans that are ``inner`` and under one that is ``outer``, with the outermost such as ``ancestor`` and how many ``levels`` it is above."""
    rows = labelled.withColumns({"_outer": F.coalesce(outer, F.lit(False)), "_inner": F.coalesce(inner, F.lit(False))}).where("_outer or _inner")
    reach = F.when(F.col("_outer"), F.struct("leave", (-F.col("enter")).alias("first"), "depth", "span_id"))  # of two that end together, the outer one
    found = before(rows, ["trace_id"], ["enter"], reach, "_reach", F.max).where("_inner and _reach.leave >= enter")
    return found.select(*labelled.columns, F.col("_reach.span_id").alias("ancestor"), (F.col("depth") - F.col("_reach.depth")).alias("levels"))


def over(labelled: DataFrame, outer: Column, inner: Column) -> DataFrame:
    """Spans that are ``outer`` and have one that is ``inner`` under them, with how many as ``n``."""
    one = F.when(inner, 1).otherwise(0)
    counted = checkpointed(before(labelled, ["trace_id"], ["enter"], one, "_n").withColumn("_n", F.coalesce("_n", F.lit(0)) + one))
    ends = counted.select("trace_id", F.col("enter").alias("leave"), F.col("_n").alias("_end"))
    return counted.where(outer).join(ends, ["trace_id", "leave"]).withColumn("n", F.col("_end") - F.col("_n")).where("n > 0").select(*labelled.columns, "n")


def beside(labelled: DataFrame, one: Column, other: Column) -> DataFrame:
    """Spans that are ``one`` and have a sibling that is ``other``, with how many other siblings as ``n``; roots of a trace are siblings."""
    place = F.coalesce("parent", F.lit("")).alias("_place")
    n = labelled.where(other).groupBy("trace_id", place).agg(F.count("*").alias("_n"))
    rows = labelled.where(one).withColumn("_place", place).join(n, ["trace_id", "_place"])
    return rows.withColumn("n", F.col("_n") - F.when(other, 1).otherwise(0)).where("n > 0").select(*labelled.columns, "n")
