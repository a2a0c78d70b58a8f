"""More registered queries: metric registry, reports, limits and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import content, deltas, fanout, metrics, profile, registry, reports, threads, turns
from turnlake.plans.queries import _QUERIES, _SQL, ANSWERS, EVENTS, PATHS, _events, _frames, _raw_events, query
from turnlake.sources import frames as wire
from turnlake.sources.tables import checkpointed, json_lines, since, table
from turnlake.streaming import jobs

WIDE = """l as (select l_returnflag as model, case when l_linestatus = 'O' then 'error' else 'completed' end as status, case when l_linenumber % 2 = 1 then 'turn' else 'warm' end as request_kind,
  (l_quantity * 10)::bigint as input_tokens, l_linenumber::bigint as output_tokens, l_linenumber::bigint - 1 as tool_calls, 'e' || l_linenumber as error_type, l_suppkey::varchar as account_id,
  l_quantity as q, l_discount as limit_used, 'w' || (l_linenumber % 2) as w, (l_orderkey, l_linenumber, l_partkey, l_suppkey) as seq from lineitem)"""


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr(
        "l_returnflag as model", "if(l_linestatus = 'O', 'error', 'completed') as status", "if(l_linenumber % 2 = 1, 'turn', 'warm') as request_kind", "cast(l_quantity * 10 as long) as input_tokens",
        "cast(l_linenumber as long) as output_tokens", "cast(l_linenumber - 1 as long) as tool_calls", "concat('e', l_linenumber) as error_type", "cast(l_suppkey as string) as account_id",
        "l_quantity * 100 as first_token_ms", "l_discount as limit_used", "concat('w', l_linenumber % 2) as window", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


_T, _S = ", ".join(f"{4**k}" for k in range(14)), ", ".join(f"{0.01 * 2**k!r}" for k in range(14))


@query("with " + WIDE + f""", p as (
 select 'responses' as metric, 'counter' as kind, 'model=' || model || ',status=' || status as labels, 1.0::double as value, seq, null::int as b from l
 union all select 'turns', 'counter', 'model=' || model || ',status=' || status, 1, seq, null from l where request_kind = 'turn'
 union all select 'tokens_input', 'counter', 'model=' || model, input_tokens, seq, null from l where input_tokens > 0
 union all select 'tokens_output', 'counter', 'model=' || model, output_tokens, seq, null from l where output_tokens > 0
 union all select 'token_usage_input', 'histogram', 'model=' || model, input_tokens, seq, len(list_filter([{_T}], lambda x: x < input_tokens)) from l where input_tokens > 0
 union all select 'token_usage_output', 'histogram', 'model=' || model, output_tokens, seq, len(list_filter([{_T}], lambda x: x < output_tokens)) from l where output_tokens > 0
 union all select 'tool_calls', 'counter', 'model=' || model, tool_calls, seq, null from l where tool_calls > 0
 union all select 'tool_calls_per_response', 'histogram', 'model=' || model, tool_calls, seq, len(list_filter([{_T}], lambda x: x < tool_calls)) from l
 union all select 'errors', 'counter', 'error_type=' || error_type || ',model=' || model, 1, seq, null from l where status = 'error'
 union all select 'time_to_first_token', 'histogram', 'model=' || model, q * 100 / 1000, seq, len(list_filter([{_S}], lambda x: x < q * 100 / 1000)) from l where q > 0
 union all select 'limit_used', 'gauge', 'account_id=' || account_id || ',window=' || w, limit_used, seq, null from l),
g as (select metric, kind, labels, sum(value) as s, count(*) as count, max_by(value, seq) as last from p group by all),
h as (select metric, labels, b, count(*) as n from p where b is not null group by all),
x as (select g.metric, g.labels, string_agg(coalesce(n, 0)::varchar, ',' order by r.b) as buckets from g cross join range(15) r(b) left join h on h.metric = g.metric and h.labels = g.labels and h.b = r.b where g.kind = 'histogram' group by all)
select g.metric, g.kind, g.labels, round(case when kind = 'gauge' then last else s end, 4)::double as value, g.count, x.buckets from g left join x on x.metric = g.metric and x.labels = g.labels""")
def metric_registry(spark: SparkSession, d: str) -> DataFrame:
    rows = registry.points(_wide(spark, d), "l_shipdate", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    out = registry.aggregate(rows)
    return out.withColumns({"value": F.round("value", 4), "buckets": F.array_join(F.transform("buckets", lambda x: x.cast("string")), ",")})


@query("with " + WIDE + """ select 'responses' as metric, count(distinct (model, status)) as sets, count(distinct (model, status)) as series from l
union all select 'time_to_first_token', count(distinct model), count(distinct model) * 17 from l where q > 0
union all select 'limit_used', count(distinct (account_id, w)), count(distinct (account_id, w)) from l""")
def series_cardinality(spark: SparkSession, d: str) -> DataFrame:
    rows = registry.points(_wide(spark, d), "l_shipdate", ["l_orderkey"])
    return registry.series_counts(rows).where("metric in ('responses', 'time_to_first_token', 'limit_used')")


@query("""select 'ws_' || s_suppkey as request_id, s_acctbal >= 0 as allowed, s_acctbal as used, 300 as minutes, case when s_suppkey % 2 = 0 then 7.5::double end as secondary_used,
s_suppkey + 1000.5::double as balance, false as unlimited from supplier""")
def rate_limit_fold(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    block = lambda used: F.struct(used.alias("used_percent"), F.lit(300).alias("window_minutes"))
    second = F.when(F.col("s_suppkey") % 2 == 0, block(F.lit(7.5)))
    limits = F.struct((F.col("s_acctbal") >= 0).alias("allowed"), block(F.col("s_acctbal")).alias("primary"), second.alias("secondary"))
    money = F.concat(F.lit(" $"), F.format_number(F.col("s_suppkey") + 1000.5, 2))
    new = F.to_json(F.struct(F.lit("codex.rate_limits").alias("type"), limits.alias("rate_limits"), F.struct(money.alias("balance"), F.lit(False).alias("unlimited")).alias("credits")))
    old = F.lit('{"type":"codex.rate_limits","rate_limits":{"allowed":true,"primary":{"used_percent":1.0,"window_minutes":5}}}')
    e = s.select(F.concat(F.lit("ws_"), F.col("s_suppkey").cast("string")).alias("request_id"), "s_suppkey", F.posexplode(F.array(old, new)).alias("k", "text"))
    raw = F.to_json(F.struct("request_id", F.struct("text").alias("payload")))
    f = wire.decode(e.select(F.lit("f").alias("file"), (F.col("s_suppkey") * 2 + F.col("k")).alias("frame_seq"), raw.alias("raw")))
    return turns.rate_limits(f).select("request_id", "allowed", "used", "minutes", "secondary_used", "balance", "unlimited")


@query(EVENTS + """, t as (select user_id, ['function_call', 'message', 'reasoning'][k % 3 + 1] as t, count(*) as n from e group by all)
select 'req-' || user_id as request_id, string_agg(t || '=' || n, ',' order by t) as items from t group by 1""")
def item_type_counts(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(x) for x in ("function_call", "message", "reasoning")]), (F.col("k") % 3 + 1).cast("int"))
    text = F.to_json(F.struct(F.lit("response.output_item.done").alias("type"), F.struct(kind.alias("type")).alias("item")))
    raw = F.to_json(F.struct(F.concat(F.lit("req-"), F.col("user_id").cast("string")).alias("request_id"), F.struct(text.alias("text")).alias("payload")))
    f = wire.decode(_events(spark, d).select(F.lit("f").alias("file"), F.col("event_id").alias("frame_seq"), raw.alias("raw")))
    return turns.item_counts(f).select("request_id", metrics.stable(F.map_from_entries(F.transform(F.map_entries("items"), lambda e: F.struct(e["key"], e["value"].cast("string"))))).alias("items"))


@query("""with o as (select a.o_custkey as thread, b.o_custkey as owner, a.o_orderkey as k from orders a join orders b on b.o_orderkey = a.o_orderkey - 32),
l as (select thread, max_by(owner, k) as owner from o group by 1) select o_custkey as thread, case when owner <> o_custkey then owner end as parent from (select distinct o_custkey from orders) left join l on thread = o_custkey""")
def thread_parents(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").selectExpr("cast(o_custkey as string) as thread", "'' as parent", "concat('T', o_orderkey - 32) as parent_turn", "concat('T', o_orderkey) as turn", "o_orderkey")
    out = reports.resolve_parents(o, "thread", "parent", "parent_turn", "turn", ["o_orderkey"])
    return out.selectExpr("cast(thread as bigint) as thread", "cast(parent as bigint) as parent")


@query("select conv_id, string_agg(role || ': ' || coalesce(text, ''), chr(10) order by turn) as text from conversations group by 1")
def thread_transcripts(spark: SparkSession, d: str) -> DataFrame:
    return reports.transcript(table(spark, d, "conversations"), "conv_id", ["turn"], F.concat_ws(": ", "role", F.coalesce("text", F.lit(""))))


@query("""with p as (select *, length(text) > 2000 or list_has_any(list_transform(['<environment_context', '<user_instructions', '<permissions', '<turn_aborted', '<skill', '# AGENTS.md', '<ide_', '<system', '<context'], lambda s: starts_with(ltrim(text), s)), [true]) as scaffold
from conversations where role = 'user'), a as (select conv_id, max_by(trim(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')), turn) as t from p where not scaffold group by 1)
select conv_id, case when length(t) > 200 then substr(t, 1, 199) || '…' else t end as ask from a""")
def thread_asks(spark: SparkSession, d: str) -> DataFrame:
    return reports.asks(table(spark, d, "conversations").withColumn("body", F.col("text")), "conv_id", ["turn"])


@query("""select c_custkey, field, value from (select c_custkey, c_name, c_mktsegment, c_nationkey::varchar as c_nationkey from customer) unpivot (value for field in (c_name, c_mktsegment, c_nationkey))""")
def response_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.unpivot(table(spark, d, "customer"), "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"])


@query("""with recursive t as (select conv_id as node, min(turn) + conv_id * 3600 as lo, max(turn) + conv_id * 3600 as hi, nullif(conv_id // 3, conv_id) as parent from conversations group by conv_id),
r as (select node, node as ancestor, 0 as depth from t union all select r.node, p.parent, r.depth + 1 from r join t p on p.node = r.ancestor join t q on q.node = p.parent),
m as (select max(node) // 2 as mid from t), s as (select t.node from t, m where lo <= (mid + 5) * 3600 and hi >= mid * 3600)
select distinct (select max_by(ancestor, depth) from r where r.node = s.node) as root from s""")
def window_selection(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumn("at", F.col("turn") + F.col("conv_id") * 3600)
    t = c.groupBy(F.col("conv_id").alias("node")).agg(F.min("at").alias("first_seen"), F.max("at").alias("last_seen")).withColumn("parent", F.expr("nullif(node div 3, node)"))
    mid = F.col("mid")
    spans = t.crossJoin(F.broadcast(t.agg(F.expr("max(node) div 2").alias("mid"))))  # one row
    return reports.selected(spans, threads.forest(t.select("node", "parent"), "node", "parent"), "node", mid * 3600, (mid + 5) * 3600)


@query("""with recursive s as (select conv_id, turn, length(coalesce(text, ''))::bigint as n, row_number() over (partition by conv_id order by turn) as rn from conversations),
r as (select conv_id, n, rn, 0 as chunk, n as used from s where rn = 1 union all
  select s.conv_id, s.n, s.rn, r.chunk + case when r.used > 0 and r.used + s.n > 1500 then 1 else 0 end, case when r.used > 0 and r.used + s.n > 1500 then s.n else r.used + s.n end from r join s on s.conv_id = r.conv_id and s.rn = r.rn + 1),
g as (select conv_id, sum(n)::bigint as chars, max(chunk) + 1 as passes, exists (select 1 from conversations k where k.conv_id // 3 = r.conv_id and k.conv_id <> r.conv_id) as kids from r group by conv_id)
select conv_id, chars, passes, passes + case when passes > 1 then 1 else 0 end + case when kids then 1 else 0 end as calls from g""")
def digest_estimate(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    kids = c.selectExpr("nullif(conv_id div 3, conv_id) as k").where("k is not null").distinct().withColumn("kids", F.lit(True))
    chunks = threads.pack_chunks(c, ["conv_id"], "turn", "n", 1500).join(kids, F.col("conv_id") == F.col("k"), "left").withColumn("kids", F.coalesce("kids", F.lit(False)))
    return reports.call_estimate(chunks, "conv_id", "kids")


@query("select o_orderkey, o_totalprice from orders where o_orderkey > 5000")
def incremental_rows(spark: SparkSession, d: str) -> DataFrame:
    return since(table(spark, d, "orders"), "o_orderkey", 5000).select("o_orderkey", "o_totalprice")


@query("""select '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' as value from orders""")
def json_dump(spark: SparkSession, d: str) -> DataFrame:
    return json_lines(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"))


@query("with m as (select max(ts) as now from events) select count(*) filter (ts >= now - interval 72 hours) as kept, count(*) filter (ts < now - interval 72 hours) as too_old from events, m")
def late_rows(spark: SparkSession, d: str) -> DataFrame:
    e = _raw_events(spark, d)
    rows = e.crossJoin(F.broadcast(e.agg(F.max("ts").alias("now"))))  # one row
    young, late = fanout.drop_late(rows, "ts", F.col("now"), "72 hours")
    return young.agg(F.count("*").alias("kept")).crossJoin(late)


@query("select event_type as kind, array_to_string(list_sort(json_keys(props::json)), ',') as shape, count(*) as n from events group by all")
def key_shapes(spark: SparkSession, d: str) -> DataFrame:
    return profile.key_shapes(table(spark, d, "events"), "event_type", "props")


@query(ANSWERS + """select strftime(to_timestamp(1700000000 + conv_id * 3600 + turn)::timestamp, '%Y-%m-%dT%H') || '.jsonl.gz' as file, count(*) * 6 as lines, 0::bigint as bad,
min(1700000000 + conv_id * 3600 + turn)::bigint as first, max(1700000000 + conv_id * 3600 + turn)::bigint as last from a group by 1""")
def file_profiles(spark: SparkSession, d: str) -> DataFrame:
    return profile.file_profile(_frames(spark, d)).withColumns({"first": F.unix_seconds("first"), "last": F.unix_seconds("last")})


@query("select 'all' as kind, 'role' as path, string_agg(distinct role, ',' order by role) as values from conversations")
def enum_values(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select(F.lit("all").alias("kind"), F.to_json(F.struct("role", F.concat(F.lit("id"), F.col("conv_id") + 10000).alias("id"))).alias("doc"))
    return profile.safe_enums(profile.value_counts(profile.paths(c, "kind", "doc"))).withColumn("values", F.array_join("values", ","))


@query(PATHS + "select kind, path, json_type, floor(log10(n))::int as magnitude from s")
def schema_signature(spark: SparkSession, d: str) -> DataFrame:
    return profile.signature(profile.induce(profile.paths(table(spark, d, "events"), "event_type", "props")))


@query("""with r as (select *, row_number() over (partition by event_type order by ts, event_id) as rn from events) select event_type, count(*) as n, max(rn) as last from r where rn <= 100 or (rn - 100) % 64 = 0 group by 1""")
def head_and_stride(spark: SparkSession, d: str) -> DataFrame:
    rows = profile.head_and_stride(_raw_events(spark, d), "event_type", ["ts", "event_id"], 100, 64)
    total = F.expr("100 + 64 * (count(*) - 100)")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.when(F.count("*") > 100, total).otherwise(F.count("*")).alias("last"))


@query(ANSWERS + """select ev_type, sum(n)::bigint as frames from (select unnest(['response.create', 'response.created', 'response.output_text.delta', 'response.output_item.done', 'responsesapi.websocket_timing', 'response.completed']) as ev_type, count(*) as n from a group by 1) group by 1""")
def event_survey(spark: SparkSession, d: str) -> DataFrame:
    return _frames(spark, d).groupBy("ev_type").agg(F.count("*").alias("frames"))


@query("select source as path, count(*) as n, any_value('src') as masked from (select regexp_replace(source, '[0-9]+', 'N', 'g') as source from documents where source is not null) group by 1")
def masked_values(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("source is not null")
    return rows.groupBy(X.digit_mask(F.col("source")).alias("path")).agg(F.count("*").alias("n")).withColumn("masked", F.lit("src"))


@query(ANSWERS + """select thread_id, count(*) as turns, max(strlen(text))::bigint as largest, null::varchar as body from a group by 1""")
def content_free_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(_frames(spark, d))
    g = t.groupBy("thread_id").agg(F.count("*").alias("turns"), F.max("output_tokens").alias("largest"), F.first("response_id").alias("body"))
    return reports.content_free(g)


@query(ANSWERS + """, p as (select conv_id, count(*) as n from a group by 1) select 'conv-' || (conv_id // 3) as author, 'conv-' || conv_id as recipient, n as messages from p where conv_id // 3 <> conv_id""")
def agent_graph(spark: SparkSession, d: str) -> DataFrame:
    t = checkpointed(turns.assemble(_frames(spark, d)).select("thread_id", "parent_thread_id"))
    edges = t.where("parent_thread_id is not null").groupBy(F.col("parent_thread_id").alias("author"), F.col("thread_id").alias("recipient"))
    return edges.agg(F.count("*").alias("messages"))


_MATCH = _SQL["call_output_match"]


@query(_MATCH.replace("select user_id, k, event_id, match, matched_ref from r where event_type = 'view'", "select match, count(*) as n from r where event_type = 'view' group by 1"))
def match_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return _QUERIES["call_output_match"](spark, d).groupBy("match").agg(F.count("*").alias("n"))


@query(_MATCH.replace("select user_id, k, event_id, match, matched_ref from r where event_type = 'view'", """select user_id, event_id, substr(sha256('thread' || chr(0) || user_id), 1, 32) as trace_id,
  substr(sha256('tool' || chr(0) || user_id || chr(0) || matched_ref), 33, 16) as link_span_id from r where event_type = 'view' and match = 'exact' and matched_ref % 10 <> event_id % 10"""))  # fmt: skip
def result_links(spark: SparkSession, d: str) -> DataFrame:
    m = _QUERIES["call_output_match"](spark, d)
    return fanout.result_links(m, "user_id", "event_id", F.col("matched_ref") % 10, F.col("event_id") % 10)


@query("""with n as (select user_id, case when event_type in ('click', 'view') then event_type else 'unknown' end as k, count(*) as n from events group by all)
select user_id, string_agg(k || '=' || n, ',' order by k) as kinds from n group by 1""")
def content_kinds(spark: SparkSession, d: str) -> DataFrame:
    out = content.kind_counts(table(spark, d, "events"), ["user_id"], "event_type", ("click", "view"))
    return out.select("user_id", F.array_join(F.transform(F.array_sort(F.map_entries("kinds")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("kinds"))


@query("with r as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) select user_id, event_id from r where rn <= 5")
def bounded_history(spark: SparkSession, d: str) -> DataFrame:
    return content.bounded_history(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 5).select("user_id", "event_id")


@query("""with f as (select user_id, event_type, min((case when event_type in ('click', 'view') then 0 else 1 end, ts, event_id)) as o from events group by all)
select user_id, string_agg(event_type, ',' order by o) as names from f group by 1""")
def merged_tools(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    seen = F.col("event_type").isin("click", "view")
    return content.merged_tools(e.where(seen), e.where(~seen), ["user_id"], "event_type", ["ts", "event_id"]).withColumn("names", F.array_join("names", ","))


@query("""select o_orderstatus, substr(o_orderpriority, 1, 1) as code, count(*) as n from orders where o_orderstatus <> substr(o_orderpriority, 1, 1) and (o_orderstatus <> '' or o_orderpriority <> '') group by 1, 2""")
def code_mismatches(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("code", F.substring("o_orderpriority", 1, 1))
    return o.where("o_orderstatus <> code and (o_orderstatus <> '' or code <> '')").groupBy("o_orderstatus", "code").agg(F.count("*").alias("n"))


@query("""select l_returnflag, round(sum(l_extendedprice) / count(distinct l_orderkey), 4) as per_order, round(1000000 * sum(l_extendedprice) / greatest(sum(l_quantity) + sum(l_linenumber), 1), 2) as per_million,
round(sum(l_tax) / greatest(sum(l_discount), 0.000001), 6)::double as ratio from lineitem group by 1""")
def unit_economics(spark: SparkSession, d: str) -> DataFrame:
    tokens = F.sum("l_quantity") + F.sum("l_linenumber")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.sum("l_extendedprice") / F.countDistinct("l_orderkey"), 4).alias("per_order"), F.round(1000000 * F.sum("l_extendedprice") / F.greatest(tokens, F.lit(1.0)), 2).alias("per_million"),
        F.round(F.sum("l_tax") / F.greatest(F.sum("l_discount"), F.lit(0.000001)), 6).alias("ratio"),
    )


@query("""with n as (select *, lead(ts) over (partition by user_id order by ts, event_id) as nxt from events)
select user_id::varchar as trace_id, max((epoch_us(nxt) - epoch_us(ts)) // 1000)::bigint as longest_ms from n group by 1 having max((epoch_us(nxt) - epoch_us(ts)) // 1000) > 36000000""")
def long_traces(spark: SparkSession, d: str) -> DataFrame:
    after = F.lead("ts").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return fanout.search_spans(_raw_events(spark, d).select(F.col("user_id").cast("string").alias("trace_id"), F.col("ts").alias("start"), after.alias("end")), 36_000_000)


@query(ANSWERS + "select count(*) * 6 as lines, 0::bigint as undecodable, count(*) as deltas, 0::bigint as open, max(1700000000 + conv_id * 3600 + turn)::bigint as newest from a")
def pipeline_health(spark: SparkSession, d: str) -> DataFrame:
    return jobs.health(_frames(spark, d)).withColumn("newest", F.unix_seconds("newest"))


@query(ANSWERS + "select request_id, 'completed' as status, 6::bigint as frames, 'm1' as model, strlen(text)::bigint as output_tokens from a")
def streamed_turns(spark: SparkSession, d: str) -> DataFrame:
    lines = checkpointed(wire.render(table(spark, d, "conversations")))
    folder = lines.inputFiles()[0].rsplit("/", 1)[0]
    stream = wire.decode(spark.readStream.schema(lines.schema).parquet(folder))
    out = jobs.drain(jobs.assemble(stream), folder.rsplit("/", 1)[0])
    return out.select("request_id", "status", "frames", "model", "output_tokens")


@query(EVENTS + " select (k % 3)::varchar as kind, event_type as event, count(*) as n, min(event_id) as sample from e group by 1, 2")
def kind_event_table(spark: SparkSession, d: str) -> DataFrame:
    return profile.cross_tab(_events(spark, d).withColumn("kind", (F.col("k") % 3).cast("string")), "kind", "event_type", "event_id")


@query("""with n as (select event_type, max(event_id) + 1 as n from events group by 1), x as (select e.event_type, event_id - ((event_id * 10 // n) * n) // 10 < 50 as inside from events e join n using (event_type))
select event_type, count(*) as rows, count(*) filter (inside) as sampled, count(*) filter (inside) / count(*) as coverage from x group by 1""")
def sample_coverage(spark: SparkSession, d: str) -> DataFrame:
    return profile.sampled_windows(table(spark, d, "events"), "event_type", "event_id", 10, 50)[1]


@query("""with l as (select l_orderkey, l_partkey, l_quantity, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as occurrence from lineitem)
select l_orderkey, occurrence, l_partkey as call_id, substr(sha256('tool' || chr(0) || l_orderkey || chr(0) || l_partkey || chr(0) || occurrence), 33, 16) as span_id,
case when l_orderkey % 2 = 0 then l_quantity end as duration_ms from l""")
def tool_spans(spark: SparkSession, d: str) -> DataFrame:
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    g = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("x"))  # an order's lines
    durations = F.transform("x", lambda v: v["l_quantity"])
    g = g.select("l_orderkey", F.transform("x", lambda v: v["l_partkey"]).alias("calls"), F.when(F.col("l_orderkey") % 2 == 0, durations).otherwise(F.slice(durations, 1, 0)).alias("times"))
    return fanout.tool_spans(g, "l_orderkey", "calls", "times")


@query("""select o_orderkey, case when regexp_matches(lower(o_orderpriority || ' ' || o_orderstatus), 'rate|quota|limit|429') then 'rate_limit' when regexp_matches(lower(o_orderpriority || ' ' || o_orderstatus), 'auth|401|403|forbidden') then 'auth'
when regexp_matches(lower(o_orderpriority || ' ' || o_orderstatus), 'timeout|deadline|504') then 'timeout' when regexp_matches(lower(o_orderpriority || ' ' || o_orderstatus), 'server|overload|5[0-9][0-9]') then 'server'
when regexp_matches(lower(o_orderpriority || ' ' || o_orderstatus), 'invalid|400|not_found|404') then 'invalid' else 'other' end as category, coalesce(nullif(o_orderstatus, 'F'), o_orderpriority) as model from orders""")
def derived_labels(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    retry = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", metrics.error_category(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("category"), metrics.response_model(retry, F.col("o_orderpriority")).alias("model"))


@query("""with b as (select user_id, event_type, max(ts) as ts from events group by 1, 2), m as (select max(ts) - interval 7 days as cut from events),
o as (select user_id from events group by 1 having max_by(event_type, (ts, event_id)) = 'error')
select user_id, event_type from b, m where ts >= cut or user_id in (select user_id from o)""")
def live_baselines(spark: SparkSession, d: str) -> DataFrame:
    e = _raw_events(spark, d)
    b = e.groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"))
    last = e.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("t"))
    cut = e.agg((F.max("ts") - F.expr("interval 7 days")).alias("cut"))
    out = deltas.live_baselines(b.crossJoin(F.broadcast(cut)), "user_id", "ts", F.col("cut"), last.where("t = 'error'"))  # one row
    return out.select("user_id", "event_type")
