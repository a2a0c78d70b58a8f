"""Capture archives: gzip JSON lines, one frame a line, in files named by hour; and the same frames rendered from plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X

LINE = (
    "request_id string, timestamp string, account_id string, direction string, headers map<string,string>, kind string, method string, "
    "payload struct<text: variant, error: variant>, transport string, url string, extra struct<frame_type: string, close_code: int>, _bad string"
)
#: The streaming event types, which are counted and never decoded, and the types that end a response.
DELTAS = ("response.output_text.delta", "response.function_call_arguments.delta", "response.custom_tool_call_input.delta")
TERMINAL = ("response.completed", "error")
KNOWN = (
    "response.create", "response.created", "response.in_progress", "response.output_item.done", "responsesapi.websocket_timing",
    "response.completed", "codex.rate_limits", "codex.response.metadata", "response.metadata", "error", *DELTAS,
)


#: The columns that decoding adds.
FRAME = frozenset(
    "decode_ok request_id account_id direction kind method transport url ts_raw ts headers frame_type close_code payload_text ev_type is_delta is_transport"
    " family event".split()
)


def read_archives(spark: SparkSession, path: str, names: str = "*.jsonl.gz") -> DataFrame:
    """``(file, frame_seq, raw)`` of all archives below a path. A truncated last member yields the lines that are whole.

    One task reads one gzip file in order, so within a file ``frame_seq`` grows with the position; files order by name.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).option("ignoreCorruptFiles", "true").text(path)
    )
    return lines.select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("frame_seq"), F.col("value").alias("raw"))


def archive_lines(spark: SparkSession, paths: str | list[str], names: str = "*") -> DataFrame:
    """:func:`read_archives` of folders or of named files, with whole paths in ``file``."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("pathGlobFilter", names)
    lines = (reader.option("recursiveFileLookup", "true") if isinstance(paths, str) else reader).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("frame_seq"), F.col("value").alias("raw"))


def archive_hour(name: Column) -> Column:
    """The hour in an archive's name, or null."""
    return F.try_to_timestamp(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2}T\d{2})", 1), F.lit("yyyy-MM-dd'T'HH"))


def in_window(name: Column, begin: Column, end: Column, slop: str = "1 hour") -> Column:
    """Whether an archive's hour overlaps a window widened by the slop; names without an hour stay."""
    hour = archive_hour(name)
    s = F.expr(f"interval {slop}")
    return hour.isNull() | ((hour <= end + s) & (hour + F.expr("interval 1 hour") >= begin - s))


def decode(lines: DataFrame) -> DataFrame:
    """Frames from raw lines. Lines that aren't JSON objects stay, with ``decode_ok`` false and the rest null. Columns of the lines stay, but for
    those that a frame has itself.

    Streaming deltas are recognised by their type and keep no event: most frames are deltas.
    """
    j = F.from_json("raw", LINE, {"columnNameOfCorruptRecord": "_bad"})
    df = lines.withColumn("_j", j)
    ok = F.col("_j").isNotNull() & F.col("_j._bad").isNull()
    df = df.select(
        *[c for c in lines.columns if c not in FRAME],
        F.coalesce(ok, F.lit(False)).alias("decode_ok"),
        *[F.col(f"_j.{c}").alias(c) for c in ("request_id", "account_id", "direction", "kind", "method", "transport", "url")],
        F.col("_j.timestamp").alias("ts_raw"),
        F.try_to_timestamp("_j.timestamp").alias("ts"),
        X.lower_keys(F.col("_j.headers")).alias("headers"),
        F.col("_j.extra.frame_type").alias("frame_type"),
        F.col("_j.extra.close_code").alias("close_code"),
        X.payload_text(F.col("_j.payload.text"), F.col("_j.payload.error")).alias("payload_text"),
    )
    df = df.withColumn("_ev", X.event(F.col("payload_text")))
    df = df.withColumn("ev_type", F.try_variant_get("_ev", "$.type", "string"))
    return df.select(
        *[c for c in df.columns if c not in ("_ev", "ev_type")],
        "ev_type",
        F.coalesce(F.col("ev_type").isin(*DELTAS), F.lit(False)).alias("is_delta"),
        F.coalesce(F.col("frame_type").isin("error", "close"), F.lit(False)).alias("is_transport"),
        X.family(F.col("headers")["originator"], F.col("request_id")).alias("family"),
        F.when(F.col("ev_type").isin(*DELTAS), None).otherwise(F.to_json("_ev")).alias("event"),
    )


def lookup(lines: DataFrame, found: Column) -> DataFrame:
    """Decoded frames of every request that any line for which ``found`` holds belongs to; only these lines are decoded.

    ``found`` is a test of ``raw``. Lines without a request id are left out, found or not.
    """
    rid = F.regexp_extract("raw", r'"request_id"\s*:\s*"([^"\\]*)"', 1)
    keyed = lines.withColumn("_rid", rid).where("_rid <> ''")
    hits = keyed.where(found).select("_rid").distinct()
    return decode(keyed.join(hits, "_rid", "left_semi").drop("_rid"))


def unknown_events(frames: DataFrame) -> DataFrame:
    """Event types in a capture that nothing here decodes, with their frame counts."""
    known = frames.sparkSession.createDataFrame([(k,) for k in KNOWN], "ev_type string")
    seen = frames.where("ev_type is not null").groupBy("ev_type").agg(F.count("*").alias("frames"))
    return seen.join(F.broadcast(known), "ev_type", "left_anti")  # a fixed list


def reconcile(remote: DataFrame, local: DataFrame) -> DataFrame:
    """What to do for each remote file, from two inventories of ``(name, size, fingerprint)``: new, grown, current or replaced."""
    l = local.select("name", F.col("size").alias("l_size"), F.col("fingerprint").alias("l_print"))
    action = (
        F.when(F.col("l_print").isNull(), "new")
        .when(F.col("l_print") != F.col("fingerprint"), "replaced")
        .when(F.col("size") > F.col("l_size"), "grown")
        .otherwise("current")
    )
    return remote.join(l, "name", "left").select("name", action.alias("action"))


def removable(files: DataFrame, newest: Column, keep_days: int) -> DataFrame:
    """Fully read files of days older than the limit before ``newest``; the newest file always stays."""
    last = files.agg(F.max("name").alias("last"))
    return files.crossJoin(F.broadcast(last)).where(  # one row
        F.col("read_all") & (F.col("name") != F.col("last")) & (F.datediff(newest, archive_hour(F.col("name"))) > keep_days)
    ).select("name")


def render(conversations: DataFrame) -> DataFrame:
    """Wire lines ``(file, frame_seq, raw)`` of conversations ``(conv_id, turn, role, text)``: each assistant row is one response.

    Null texts count as empty. A create frame re-sends all earlier rows of its conversation, as agents do. Timing counters are cumulative in a thread and start again
    at turns divisible by four. The payload is a JSON string, an object or a server-sent event by ``conv_id`` modulo three.
    """
    w = Window.partitionBy("conv_id").orderBy("turn")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("text")
    item = F.struct(F.lit("message").alias("type"), "role", F.col("text").alias("content"))
    seen = F.when(F.col("role").isin("user", "assistant"), item)
    rows = conversations.withColumn("text", F.coalesce("text", F.lit(""))).select(
        "conv_id", "turn", "role", "text",
        F.collect_list(seen).over(past).alias("input"),
        F.last(F.when(F.col("role") == "system", F.col("text")), True).over(past).alias("instructions"),
        F.coalesce(F.sum(F.when(F.col("role").isin("user", "assistant"), size)).over(past), F.lit(0)).alias("input_bytes"),
        F.sum(F.when((F.col("role") == "assistant") & (F.col("turn") % 4 == 0), 1).otherwise(0)).over(w).alias("part"),
    )
    answers = rows.where("role = 'assistant'")
    p = Window.partitionBy("conv_id", "part").orderBy("turn")
    answers = answers.withColumn("calls", F.row_number().over(p)).withColumn("sampled", F.sum(size).over(p))
    rid = F.concat_ws("_", F.lit("ws"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    resp = F.concat(F.lit("resp_"), rid)
    js = lambda **k: F.to_json(F.struct(*[v.alias(n) for n, v in k.items()]))
    typed = lambda t, **k: js(type=F.lit(t), **k)
    sub = lambda **k: F.struct(*[v.alias(n) for n, v in k.items()])
    frames = [
        typed("response.create", model=F.lit("m1"), reasoning=sub(effort=F.lit("high")), instructions=F.col("instructions"), input=F.col("input")),
        typed("response.created", response=sub(id=resp, model=F.lit("m1"))),
        typed(DELTAS[0], delta=F.lit("x")),
        typed("response.output_item.done", item=sub(type=F.lit("message"), content=F.array(sub(type=F.lit("output_text"), text=F.col("text"))))),
        typed("responsesapi.websocket_timing", timing_metrics=sub(num_engine_calls=F.col("calls"), num_sampled_tokens_total=F.col("sampled"))),
        typed("response.completed", response=sub(id=resp, status=F.lit("completed"), usage=sub(
            input_tokens=F.col("input_bytes"), output_tokens=size, input_tokens_details=sub(cached_tokens=(F.col("input_bytes") / 2).cast("long"))))),
    ]
    time = F.expr("timestamp_seconds(1700000000 + conv_id * 3600 + turn)")
    e = answers.select("*", F.posexplode(F.array(*frames)).alias("k", "ev"))
    text = F.when(F.col("conv_id") % 3 == 2, F.concat(F.lit("event: e\ndata: "), F.col("ev"), F.lit("\n\n"))).otherwise(F.col("ev"))
    parent = F.expr("conv_id div 3")
    thread_name = F.when(F.col("conv_id") % 2 == 1, "Thread-Id").otherwise("thread-id")
    headers = F.map_from_arrays(
        F.array(thread_name, F.lit("X-Parent-Thread-Id")),
        F.array(F.concat(F.lit("conv-"), F.col("conv_id").cast("string")), F.when(parent != F.col("conv_id"), F.concat(F.lit("conv-"), parent.cast("string"))).otherwise("")),
    )
    head = js(
        request_id=rid, timestamp=F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"), account_id=F.concat(F.lit("acct_"), (F.col("conv_id") % 5).cast("string")),
        headers=headers, kind=F.lit("responses"), transport=F.lit("websocket"), extra=sub(frame_type=F.lit("text")),
    )
    payload = F.when(F.col("conv_id") % 3 == 1, F.concat(F.lit('{"text":'), F.col("ev"), F.lit("}"))).otherwise(js(text=text))
    raw = F.concat(F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"payload":'), payload, F.lit("}"))
    file = F.concat(F.date_format(time, "yyyy-MM-dd'T'HH"), F.lit(".jsonl.gz"))
    return e.withColumn("_h", head).select(file.alias("file"), (F.col("conv_id") * 100 + F.col("turn")).alias("_o"), "k", raw.alias("raw")).select(
        "file", (F.col("_o") * 10 + F.col("k")).alias("frame_seq"), "raw"
    )
