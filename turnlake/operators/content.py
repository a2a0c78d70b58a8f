"""What responses carry: re-sent history seen once, calls matched to outputs, one ordinal over all kinds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from turnlake.functions import columns as X
from turnlake.operators.turns import ORDER, segment


def first_seen(rows: DataFrame, scope: list[str], body: Column, order: list[str]) -> DataFrame:
    """The first row of every distinct body in its scope. Aggregates before it shuffles: a body that is re-sent often is no hot group."""
    seq = F.struct(*order)
    key = F.sha2(F.concat_ws(X.NUL, *[F.col(s).cast("string") for s in scope], body), 256)
    packed = rows.where(body.isNotNull()).select(key.alias("_k"), seq.alias("_o"), F.struct(*rows.columns).alias("_r"))
    return packed.groupBy("_k").agg(F.min_by("_r", "_o").alias("r")).select("r.*")


_ITEM = (
    "struct<id: string, type: string, role: string, call_id: string, author: string, recipient: string, content: variant, output: variant, tools: string, "
    "internal_chat_message_metadata_passthrough: struct<turn_id: string, create_time: double, content_item_kinds: array<string>>>"
)
#: The kinds of content that a message may declare; any other counts as unknown.
CONTENT_KINDS = (
    "model.base_instructions", "model_switch.instructions", "memories.instructions", "host_skills.instructions", "permissions.instructions",
    "collaboration_mode.instructions", "apps.instructions", "plugins.usage_instructions", "plugins.recommendations", "multi_agent.usage_hint",
    "multi_agent.mode_instructions", "multi_agent.role_instructions", "agents_md.instructions", "environments.environment_context",
    "hooks.additional_context", "user.text", "generic.turn_aborted", "unknown",
)
OUTPUT_TYPES, CALL_TYPES = ("custom_tool_call_output", "function_call_output"), ("custom_tool_call", "function_call")
#: Bytes that stay of a prompt and of a tool's output.
MAX_PROMPT, MAX_OUTPUT = 32_768, 4_096
KEYS = ("request_id", "instance", "thread_id", "ts", *ORDER)


def owned(frames: DataFrame) -> DataFrame:
    """Segmented frames with their ``thread_id``, the one that a create event of the response names, else the header's, and ``response``, the id that
    the server gave, else the request's. Frames that have these stay as they are, so a table of them serves all operators with one shuffle and sort.
    """
    if "response" in frames.columns:
        return frames
    df, so_far = segment(frames), Window.partitionBy("request_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)

    def last(event_type: str, path: str) -> Column:
        """The last such value in the request, where it is of the same response: in the order in which the frames already are."""
        value = X.present(F.when(F.col("ev_type") == event_type, F.get_json_object("event", path)))
        found = F.last(F.when(value.isNotNull(), F.struct("instance", value.alias("value"))), True).over(so_far)
        return F.when(found["instance"] == F.col("instance"), found["value"])

    df = df.withColumns({"_thread": last("response.create", "$.client_metadata.thread_id"), "response": F.coalesce(last("response.created", "$.response.id"), "request_id")})
    return df.withColumn("thread_id", X.first_present(F.col("_thread"), F.col("headers")["thread-id"])).drop("_thread")


def _owned(frames: DataFrame, event_type: str) -> DataFrame:
    """A type's events with their response and thread."""
    return owned(frames).where(F.col("ev_type") == event_type)


def input_items(frames: DataFrame) -> DataFrame:
    """Items of create frames: the keys, ``pos, item_id, item_type, role, call_id, author, recipient, body, content, tools, kinds``. Items stay as they
    are, so a table of them serves prompts, outputs and agents' messages with one parse."""
    if "item_type" in frames.columns:
        return frames
    df = _owned(frames, "response.create")
    items = F.from_json(F.get_json_object("event", "$.input"), f"array<{_ITEM}>")
    e = df.select(*KEYS, F.posexplode(items).alias("pos", "i"))
    body = F.when(F.col("i.type") == "message", X.flat_text(F.col("i.content"))).otherwise(X.first_present(X.flat_text(F.col("i.output")), X.flat_text(F.col("i.content"))))
    return e.select(
        *KEYS, "pos", F.col("i.id").alias("item_id"), F.coalesce("i.type", F.lit("message")).alias("item_type"), F.col("i.role").alias("role"),
        F.col("i.call_id").alias("call_id"), F.col("i.author").alias("author"), F.col("i.recipient").alias("recipient"), body.alias("body"), F.to_json("i.content").alias("content"),
        F.col("i.tools").alias("tools"), F.col("i.internal_chat_message_metadata_passthrough.content_item_kinds").alias("kinds"),
    )


def images(content: Column) -> Column:
    """``(n, mime, print)`` of a message's image parts from its content's JSON: how many, the first declared media type, and what tells them apart."""
    parts = F.from_json(content, "array<struct<image_url: string>>")
    urls = F.filter(F.transform(F.coalesce(parts, F.array().cast("array<struct<image_url: string>>")), lambda p: p["image_url"]), lambda u: u.isNotNull())
    types = F.filter(F.transform(urls, lambda u: F.regexp_extract(u, "^data:([^;,]*)[;,]", 1)), lambda t: t != "")
    prints = F.transform(urls, lambda u: F.concat(F.substring(u, 1, 47), F.lit(":"), F.octet_length(u).cast("string"), F.lit(";")))
    return F.struct(F.size(urls).alias("n"), F.get(types, F.lit(0)).alias("mime"), F.array_join(prints, "").alias("print"))


def prompts(frames: DataFrame) -> DataFrame:
    """Messages of the input, each once a thread (developer messages once in all); those with neither text nor image are skipped.

    Adds ``images, image_mime, chars`` (the whole body's bytes) and cuts ``body`` at :data:`MAX_PROMPT` bytes.
    """
    items = input_items(frames).where("item_type = 'message'").withColumn("_i", images(F.col("content"))).where("body <> '' or _i.n > 0")
    items = items.withColumn("scope", F.when(F.col("role") == "developer", "").otherwise(F.coalesce("thread_id", F.lit(""))))
    # two messages of nothing but images differ by these
    items = items.withColumns({"_key": F.concat_ws(X.NUL, F.coalesce("role", F.lit("")), F.coalesce("body", F.lit("")), "_i.print"), "chars": F.octet_length("body")})
    found = first_seen(items, ["scope"], F.col("_key"), [*ORDER, "pos"])
    return found.withColumns({"body": X.byte_cut(F.col("body"), MAX_PROMPT), "images": F.col("_i.n"), "image_mime": F.col("_i.mime")}).drop("_key", "_i", "content", "tools", "kinds")


def instruction_bodies(frames: DataFrame) -> DataFrame:
    """``hash, chars, body`` and the keys of the response that first carried it: each distinct system prompt once in all."""
    df = _owned(frames, "response.create").withColumn("body", X.present(F.get_json_object("event", "$.instructions")))
    found = first_seen(df.select(*KEYS, "body"), [], F.col("body"), list(ORDER))
    return found.withColumns({"hash": X.short_hash(F.col("body")), "chars": F.octet_length("body"), "body": X.byte_cut(F.col("body"), MAX_PROMPT)})


def agent_messages(frames: DataFrame) -> DataFrame:
    """Messages from one agent to another, each once a thread; a message without a body is an edge nevertheless."""
    items = input_items(frames).where("item_type = 'agent_message'").withColumn("scope", F.coalesce("thread_id", F.lit("")))
    key = F.concat_ws(X.NUL, *[F.coalesce(c, F.lit("")) for c in ("author", "recipient", "body")])
    found = first_seen(items.withColumn("_key", key), ["scope"], F.col("_key"), [*ORDER, "pos"])
    return found.select(*KEYS, "pos", "item_id", "author", "recipient", F.octet_length("body").alias("chars"), X.byte_cut(F.col("body"), MAX_PROMPT).alias("body"))


def tool_outputs(frames: DataFrame) -> DataFrame:
    """Results of tools, each once a thread by its call id, else its body; empty ones are skipped. ``cut`` says whether the body lost its end."""
    items = input_items(frames).where(F.col("item_type").isin(*OUTPUT_TYPES) & (F.col("body") != ""))
    items = items.withColumns({"scope": F.coalesce("thread_id", F.lit("")), "_key": X.first_present(F.col("call_id"), F.col("body"))})
    found = first_seen(items, ["scope"], F.col("_key"), [*ORDER, "pos"])
    n = F.octet_length("body")
    return found.select(*KEYS, "pos", "item_id", "call_id", n.alias("chars"), (n > MAX_OUTPUT).alias("cut"), X.byte_cut(F.col("body"), MAX_OUTPUT).alias("body"))


def tool_catalogues(frames: DataFrame) -> DataFrame:
    """``tools_hash, tools, first`` of every response that carries a tool catalogue; the definitions come with its first carrier only."""
    rows = input_items(frames).where("item_type = 'additional_tools' and tools is not null")
    rows = rows.withColumn("_t", F.from_json("tools", "array<struct<name: string, type: string, description: string, strict: boolean>>")).where("_t is not null")
    rows = rows.select(*KEYS, "pos", X.short_hash(F.col("tools")).alias("tools_hash"), "_t")
    first = rows.groupBy("tools_hash").agg(F.min(F.struct(*ORDER, "pos")).alias("_f"))  # a catalogue is one row, whatever number of responses carry it
    out = rows.join(first, "tools_hash").withColumn("first", F.struct(*ORDER, "pos") == F.col("_f"))
    return out.select(*KEYS, "tools_hash", "first", F.when(F.col("first"), F.col("_t")).alias("tools"))


def tool_calls(frames: DataFrame) -> DataFrame:
    """Calls of tools: the keys, ``item_id, kind, name, call_id, status, chars, input, hidden, cut, task_name, sub_model, sub_effort, occurrence``.

    A call that is sent again in its response counts once; the same call id in another response is another call, and ``occurrence`` numbers
    them in their thread: it starts again when the id wasn't called for a day, and is null without a thread. Functions' arguments are shown without encrypted values and within a budget; what a spawned agent gets is read of them.
    """
    item = F.from_json(F.get_json_object("event", "$.item"), "struct<id: string, type: string, name: string, call_id: string, status: string, input: string, arguments: string>")
    df = _owned(frames, "response.output_item.done").withColumn("i", item).where(F.col("i.type").isin(*CALL_TYPES))
    key = F.coalesce(X.present(F.col("i.call_id")), F.concat_ws(X.NUL, *[F.coalesce(f"i.{c}", F.lit("")) for c in ("name", "input", "arguments")]))
    df = df.withColumns({"scope": F.coalesce("thread_id", F.lit("")), "_key": F.concat_ws(X.NUL, "response", key)})
    calls = first_seen(df.select(*KEYS, "i", "scope", "_key"), ["scope"], F.col("_key"), list(ORDER))
    spawn = F.from_json("i.arguments", "struct<task_name: string, model: string, reasoning_effort: string>")
    function = F.col("i.type") == "function_call"
    calls = calls.withColumns({"_s": spawn, "_r": F.when(function, X.hidden_arguments(F.col("i.arguments")))})
    body = F.when(function, X.bound_json(F.col("_r.body"), MAX_OUTPUT)).otherwise(F.col("i.input"))
    calls = with_occurrence(calls.withColumn("_call", X.present(F.col("i.call_id"))), ["scope", "_call"], list(ORDER), "ts")
    return calls.select(
        *KEYS, F.col("i.id").alias("item_id"), F.when(function, "function").otherwise("custom").alias("kind"), F.col("i.name").alias("name"), F.col("i.call_id").alias("call_id"),
        F.col("i.status").alias("status"), F.octet_length(F.when(function, F.col("i.arguments")).otherwise(F.col("i.input"))).alias("chars"), body.alias("input"),
        F.coalesce("_r.hidden", F.lit(0)).alias("hidden"), F.coalesce(function & (F.octet_length("_r.body") > MAX_OUTPUT), F.lit(False)).alias("cut"),
        *[F.when(function, F.col(f"_s.{c}")).alias(n) for c, n in (("task_name", "task_name"), ("model", "sub_model"), ("reasoning_effort", "sub_effort"))],
        F.when(F.col("_call").isNotNull() & (F.col("scope") != ""), F.col("occurrence")).alias("occurrence"),
    )


def with_occurrence(calls: DataFrame, keys: list[str], order: list[str], ts: str, hours: int = 24) -> DataFrame:
    """The calls with ``occurrence``, their number among those of the same keys; it starts again at 1 after so many hours without one.

    The clock of a key is the latest time so far. A call that is older than that by the hours is numbered but isn't remembered; one without a
    time is remembered until the numbers start again.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    age = F.expr(f"interval {hours} hours")
    before = F.max(ts).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = calls.withColumn("_clock", F.greatest(before, F.col(ts)))
    rows = rows.withColumn("_new", F.coalesce(before < F.col("_clock") - age, F.lit(False)).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    kept = F.coalesce(F.col(ts) >= F.col("_clock") - age, F.lit(True)).cast("int")
    earlier = F.sum(kept).over(Window.partitionBy(*keys, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("occurrence", (F.coalesce(earlier, F.lit(0)) + 1).cast("int")).drop("_clock", "_new", "_run")


def matched_outputs(calls: DataFrame, outputs: DataFrame, hours: int = 24) -> DataFrame:
    """The tool outputs with ``match`` and, for exact ones, ``origin``: the call that they answer, by thread and call id. Outputs without either match none."""
    seq = lambda df: df.withColumns({"_at": F.struct("file", F.col("frame_seq").cast("long"), F.lit(0) if "pos" not in df.columns else F.col("pos") + 1), "_thread": F.coalesce("thread_id", F.lit(""))})
    name = lambda df, key: df.withColumn("ref", key)
    c = name(seq(calls), F.concat_ws(":", "request_id", "instance", "frame_seq"))
    o = name(seq(outputs), F.concat_ws(":", "request_id", "instance", "frame_seq", "pos"))
    cols = ["_thread", "call_id", "_at", "ts", "ref"]
    known = "call_id <> '' and _thread <> ''"
    got = match_outputs(c.select(*cols).where(known), o.select(*cols).where(known), ["_thread", "call_id"], "_at", "ts", hours)
    origin = c.select(F.col("ref").alias("matched_ref"), F.struct("request_id", "instance", "name", "occurrence").alias("origin"))
    got = got.join(origin, "matched_ref", "left").select("ref", "match", "origin")
    return o.join(got, "ref", "left").withColumn("match", F.coalesce("match", F.lit("none"))).drop("_at", "_thread", "ref")


def messages(frames: DataFrame) -> DataFrame:
    """Output messages: the keys, ``item_id, phase, body``; the body is the output text of its parts."""
    df = _owned(frames, "response.output_item.done").where("get_json_object(event, '$.item.type') = 'message'")
    item = F.from_json(F.get_json_object("event", "$.item"), "struct<id: string, phase: string, content: array<struct<type: string, text: string>>>")
    texts = F.transform(F.filter("i.content", lambda p: p["type"] == "output_text"), lambda p: F.coalesce(p["text"], F.lit("")))
    return df.withColumn("i", item).select(*KEYS, F.col("i.id").alias("item_id"), F.col("i.phase").alias("phase"), F.array_join(texts, "").alias("body"))


def declared_kinds(frames: DataFrame) -> DataFrame:
    """``request_id, instance, kind, n``: the kinds of content that a response's input declares; unknown ones count as one kind."""
    e = input_items(frames).select("request_id", "instance", F.explode("kinds").alias("k"))
    return e.groupBy("request_id", "instance", X.bounded(F.col("k"), CONTENT_KINDS).alias("kind")).agg(F.count("*").alias("n"))


def ordered(prompts: DataFrame, messages: DataFrame, calls: DataFrame, outputs: DataFrame, agents: DataFrame) -> DataFrame:
    """All five kinds of content in one table, ``record, keys, name, call_id, body``, with one ``ordinal`` over them in each response."""
    parts = []
    for record, df in (("prompt", prompts), ("message", messages), ("tool_call", calls), ("tool_output", outputs), ("agent_message", agents)):
        has = lambda c, other="string": F.col(c) if c in df.columns else F.lit(None).cast(other)  # noqa: E731, B023
        name = {"tool_call": "name", "agent_message": "author", "prompt": "role"}.get(record)
        text = "input" if record == "tool_call" else "body"
        parts.append(df.select(F.lit(record).alias("record"), *KEYS, F.coalesce(has("pos", "int"), F.lit(-1)).alias("pos"), (F.col(name) if name else F.lit(None).cast("string")).alias("name"), has("recipient").alias("recipient"), has("call_id").alias("call_id"), F.col(text).alias("body")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return with_ordinal(rows, ["request_id", "instance"], [*ORDER, "pos"])


def with_ordinal(items: DataFrame, turn: list[str], order: list[str]) -> DataFrame:
    return items.withColumn("ordinal", F.row_number().over(Window.partitionBy(*turn).orderBy(*order)))


def match_outputs(calls: DataFrame, outputs: DataFrame, keys: list[str], order: str, ts: str, hours: int = 24, call_ref: str = "ref") -> DataFrame:
    """Match tool outputs to calls of the same keys that are unconsumed and at most ``hours`` old by the key's clock, the latest time so far.

    Calls without a time don't age, and outputs without one leave the clock as it is. One such call is an exact match and is consumed, several are ambiguous, none is none; ``ref`` names the call. Gives the outputs with
    ``match`` and, for exact ones, ``matched_ref``. A key's rows stream through one task in order, which holds one batch of them and the
    calls that are still open.
    """
    pack = lambda df, kind: df.select(*keys, F.col(order).alias("_o"), F.lit(kind).alias("_kind"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_ts"), F.col(call_ref).alias("_ref"))
    rows = pack(calls, 0).unionByName(pack(outputs, 1))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "_o", "_kind", "_ts", "_ref")
    n, age = len(keys), hours * 3_600_000_000
    fields = {f.name: f for f in rows.schema.fields}
    out = StructType([*[fields[k] for k in keys], StructField("_ref", fields["_ref"].dataType), StructField("match", StringType()), StructField("matched_ref", fields["_ref"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, live, count, clock = None, [], 0, -math.inf  # a heap: the oldest open call is the first to go
        for batch in batches:
            at, match, matched = [], [], []
            for i, (*key, kind, when, ref) in enumerate(zip(*[batch.column(c).to_pylist() for c in (*range(n), n + 1, n + 2, n + 3)], strict=True)):
                if key != last:
                    last, live, clock = key, [], -math.inf
                clock = clock if when is None else max(clock, when)
                while live and live[0][0] < clock - age:
                    heapq.heappop(live)
                if kind == 1:
                    exact = len(live) == 1
                    at.append(i)
                    match.append("exact" if exact else "ambiguous" if live else "none")
                    matched.append(live.pop()[2] if exact else None)
                else:
                    count += 1
                    heapq.heappush(live, (math.inf if when is None else when, count, ref))
            took = batch.take(pa.array(at, pa.int64()))
            columns = [*took.columns[:n], took.column(n + 3), pa.array(match, pa.string()), pa.array(matched, took.schema.field(n + 3).type)]
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(run, out).withColumnRenamed("_ref", call_ref)


class CallIndex:
    """A thread's calls that an output may still answer, in the order in which they came.

    The clock is the latest time so far and never runs back. Calls older than ``hours`` go, and beyond ``most`` calls the first ones do. A call
    that was answered stays until then, so that its id's next call gets the next occurrence. Times are in microseconds or None.
    """

    def __init__(self, hours: int = 24, most: int = 512, clock: int | None = None, made: int = 0) -> None:
        self.age, self.most, self.clock, self.made = hours * 3_600_000_000, most, clock, made
        self.entries: dict[int, list] = {}  # number: call id, time, occurrence, ref, answered
        self._of: dict[str, list[int]] = {}
        self._old: list[tuple[int, int]] = []
        #: Numbers that were dropped, and entries that are new or changed, since these were last cleared: what a store has to write.
        self.dropped: set[int] = set()
        self.changed: set[int] = set()

    def put(self, n: int, entry: list) -> None:
        self.entries[n] = entry
        self._of.setdefault(entry[0], []).append(n)
        if entry[1] is not None:
            heapq.heappush(self._old, (entry[1], n))

    def _drop(self, n: int) -> None:
        call = self.entries.pop(n)[0]
        self._of[call].remove(n)
        if not self._of[call]:
            del self._of[call]
        self.dropped.add(n)

    def _advance(self, at: int | None) -> None:
        if at is not None and (self.clock is None or at > self.clock):
            self.clock = at
        while self._old and self._old[0][0] < self.clock - self.age:  # an entry with a time has set the clock
            _, n = heapq.heappop(self._old)
            if n in self.entries:
                self._drop(n)

    def record(self, call: str, at: int | None, ref) -> int:
        """Take note of a call; gives its occurrence."""
        self._advance(at)
        occurrence = 1 + max((self.entries[n][2] for n in self._of.get(call, ())), default=0)
        self.made += 1
        self.put(self.made, [call, at, occurrence, ref, False])
        self.changed.add(self.made)
        self._advance(None)
        while len(self.entries) > self.most:
            self._drop(next(iter(self.entries)))
        return occurrence

    def lookup(self, call: str, at: int | None) -> tuple[str, object, int | None]:
        """Which call an output answers: ``exact`` with the call's ref and occurrence (it is then answered), ``ambiguous`` or ``none``."""
        self._advance(at)
        open_ = [n for n in self._of.get(call, ()) if not self.entries[n][4]]
        if len(open_) != 1:
            return ("ambiguous" if open_ else "none"), None, None
        entry = self.entries[open_[0]]
        entry[4] = True
        self.changed.add(open_[0])
        return "exact", entry[3], entry[2]


#: What :func:`correlate` adds to a call or an output.
CORRELATED = "occurrence int, match string, matched_ref string"


def correlate(rows: DataFrame, thread: str, call: str, is_call: str, order: str, ts: str, ref: str, hours: int = 24, most: int = 512) -> DataFrame:
    """Calls with their ``occurrence``, and outputs with ``match``, ``matched_ref`` and the matched call's ``occurrence``, by a fold over each thread.

    One row for each row that isn't null in ``is_call``: ``thread, call, is_call, order, ref`` under their names and the three columns. Rows
    without a thread or a call id get no occurrence, and match ``none``. Within a thread the rows' order decides; at most ``most`` calls of it
    are remembered, each for ``hours`` (see :class:`CallIndex`). A thread's rows stream through one task, which holds a batch and these calls.
    """
    names = [thread, call, is_call, order, ref]
    rows = rows.withColumn(ref, F.col(ref).cast("string")).where(F.col(is_call).isNotNull()).select(*names, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    known = (F.coalesce(thread, F.lit("")) != "") & (F.coalesce(call, F.lit("")) != "")
    apart = rows.where(~known).select(*names, F.lit(None).cast("int").alias("occurrence"), F.when(~F.col(is_call), "none").alias("match"), F.lit(None).cast("string").alias("matched_ref"))
    sorted_ = rows.where(known).repartition(thread).sortWithinPartitions(thread, order, ref)
    out = StructType([*[rows.schema[c] for c in names], StructField("occurrence", IntegerType()), StructField("match", StringType()), StructField("matched_ref", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, CallIndex(hours, most)
        for batch in batches:
            found = []
            for who, call_id, calls, name, at in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)], strict=True):
                if who != last:
                    last, index = who, CallIndex(hours, most)
                if calls:
                    found.append((index.record(call_id, at, name), None, None))
                else:
                    match, matched, occurrence = index.lookup(call_id, at)
                    found.append((occurrence, match, matched))
            added = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *added], out.names)

    return sorted_.mapInArrow(run, out).unionByName(apart)


def bounded_history(rows: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The newest ``most`` rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).drop("_r")


def kind_counts(rows: DataFrame, keys: list[str], kind: str, known: tuple[str, ...]) -> DataFrame:
    """``keys, kinds``: a map of bounded kinds to counts."""
    n = rows.groupBy(*keys, X.bounded(F.col(kind), known).alias("k")).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("kinds"))


def names_in_order(rows: DataFrame, keys: list[str], name: str, order: list[str]) -> DataFrame:
    """Each key's distinct names by first appearance."""
    first = rows.where(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.min(F.struct(*order)).alias("o"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("o", name))), lambda x: x[name]).alias("names"))


def merged_tools(defined: DataFrame, called: DataFrame, keys: list[str], name: str, order: list[str]) -> DataFrame:
    """Defined tools first, then called ones that no definition names, each by first appearance."""
    rank = lambda df, i: df.select(*keys, name, F.struct(F.lit(i).alias("i"), *order).alias("o"))
    return names_in_order(rank(defined, 0).unionByName(rank(called, 1)), keys, name, ["o"])
