"""What people read: who a thread is, what it says, how large its digest is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.functions import columns as X

#: Starts of prompts that tools write and people don't.
SCAFFOLD = ("<environment_context", "<user_instructions", "<permissions", "<turn_aborted", "<skill", "# AGENTS.md", "<ide_", "<system", "<context")


def is_scaffold(c: Column) -> Column:
    t = F.ltrim(c)
    starts = t.startswith(SCAFFOLD[0])
    for s in SCAFFOLD[1:]:
        starts = starts | t.startswith(s)
    return (F.length(c) > 2000) | starts


def asks(prompts: DataFrame, thread: str, order: list[str]) -> DataFrame:
    """Each thread's last prompt by a person, on one line."""
    own = prompts.where((F.col("role") == "user") & ~is_scaffold(F.col("body")))
    return own.groupBy(thread).agg(F.max_by(X.one_line(F.col("body"), 200), F.struct(*order)).alias("ask"))


def display_name(task: Column, ask: Column, parent: Column) -> Column:
    return X.first_present(F.element_at(F.split(task, "/"), -1), ask, F.when(parent.isNotNull(), "subagent").otherwise("session"))


def content_free(rows: DataFrame, hidden: tuple[str, ...] = ("body", "instructions", "ask", "text")) -> DataFrame:
    """The same columns with texts nulled."""
    return rows.select(*[F.lit(None).cast(t).alias(c) if c in hidden else F.col(c) for c, t in rows.dtypes])


def resolve_parents(turns: DataFrame, thread: str, parent: str, parent_turn: str, turn: str, order: list[str]) -> DataFrame:
    """A thread's parent: the one its turns name, else the owner of the turn they name."""
    owner = turns.where(F.col(turn) != "").groupBy(F.col(turn).alias("_t")).agg(F.max_by(thread, F.struct(*order)).alias("_owner"))
    rows = turns.join(owner, F.col(parent_turn) == F.col("_t"), "left")
    seq = F.struct(*order)
    named, owned = X.present(F.col(parent)), F.col("_owner")
    g = rows.groupBy(thread).agg(F.max_by(named, F.when(named.isNotNull(), seq)).alias("_n"), F.max_by(owned, F.when(owned.isNotNull(), seq)).alias("_o"))
    best = F.coalesce("_n", "_o")
    return g.select(thread, F.when(best != F.col(thread), best).alias(parent))


def unpivot(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A report: ``(key, field, value)`` for every present value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(key, F.explode(pairs).alias("p")).where("p.value is not null").select(key, "p.field", "p.value")


def transcript(rows: DataFrame, thread: str, order: list[str], line: Column) -> DataFrame:
    """A thread's lines in order as one text. A thread is one reader's text and fits in memory."""
    seq = F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), line.alias("line"))))
    return rows.groupBy(thread).agg(F.array_join(F.transform(seq, lambda x: x["line"]), "\n").alias("text"))


def selected(spans: DataFrame, trees: DataFrame, node: str, begin: Column, end: Column) -> DataFrame:
    """Root threads of all threads that overlap a window; ``trees`` are ``(node, root)`` of a forest."""
    inside = spans.where((F.col("first_seen") <= end) & (F.col("last_seen") >= begin)).select(F.col(node).alias("node"))
    return trees.join(inside, "node", "left_semi").select("root").distinct()


def call_estimate(chunks: DataFrame, thread: str, has_children: str) -> DataFrame:
    """Model calls for a digest: one a chunk, one more to join several chunks, one more with children."""
    g = chunks.groupBy(thread).agg(F.max("chunk").alias("_c"), F.sum("n").alias("chars"), F.max(has_children).alias("_h"))
    passes = F.col("_c") + 1
    return g.select(thread, "chars", passes.alias("passes"), (passes + F.when(passes > 1, 1).otherwise(0) + F.when(F.col("_h"), 1).otherwise(0)).alias("calls"))


def digest_plan(units: DataFrame, trees: DataFrame) -> DataFrame:
    """``session, chars, passes, subagents, calls``: what a digest of every session reads and asks, and in the row without a session all of it.

    ``units`` are ``(node, chars, passes)`` of each thread, ``trees`` its ``(node, root)`` from a forest. A thread takes a call a pass, and one more
    to join several; a session takes all its threads' calls, and one more to fold its subagents in. The whole takes one more to roll up the
    sessions, so without any it takes one. Threads without a root, that are on a cycle or under one, belong to no session.
    """
    calls = F.col("passes") + F.when(F.col("passes") > 1, 1).otherwise(0)
    own = F.col("node") == F.col("root")
    g = units.join(trees.where("root is not null").select("node", "root"), "node").groupBy(F.col("root").alias("session")).agg(
        F.sum("chars").alias("chars"), F.max(F.when(own, F.col("passes"))).alias("passes"), F.count_if(~own).alias("subagents"), F.sum(calls).alias("calls"),
    )
    g = g.withColumn("calls", F.col("calls") + F.when(F.col("subagents") > 0, 1).otherwise(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    whole = g.agg(total("chars"), total("passes"), total("subagents"), total("calls")).select(F.lit(None).cast(g.schema["session"].dataType).alias("session"), "chars", "passes", "subagents", (F.col("calls") + 1).alias("calls"))
    return g.unionByName(whole)


def message_edges(messages: DataFrame, top: int = 20) -> DataFrame:
    """``author, recipient, messages, threads``: who writes to whom in agents' messages, the ``top`` edges with most of them, ties by name.

    A message without an author or a recipient is an edge from, or to, the empty name.
    """
    name = lambda c: F.coalesce(c, F.lit("")).alias(c)
    edges = messages.groupBy(name("author"), name("recipient")).agg(F.count("*").alias("messages"), F.countDistinct("thread_id").alias("threads"))
    return edges.orderBy(F.desc("messages"), "author", "recipient").limit(top)
