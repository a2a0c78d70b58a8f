"""The registered queries: each applies an operator to whole tables, beside the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.operators import content, deltas, enrich, fanout, metrics, profile, threads, timing, turns
from turnlake.sources import frames as wire
from turnlake.sources.tables import checkpointed, shared_dir, table
from turnlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _frames(spark: SparkSession, d: str) -> DataFrame:
    return wire.decode(wire.render(table(spark, d, "conversations")))


def _raw_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _events(spark: SparkSession, d: str) -> DataFrame:
    return _raw_events(spark, d).withColumn("k", F.get_json_object("props", "$.k").cast("long"))


# Conversations as the frames say them: one row per assistant row.
ANSWERS = """
with c as (select * replace (coalesce(text, '') as text) from conversations),
w as (select *, 'ws_' || conv_id || '_' || turn as request_id, 'conv-' || conv_id as thread_id,
  coalesce(sum(case when role in ('user', 'assistant') then strlen(text) end) over past, 0)::bigint as input_bytes,
  last_value(case when role = 'system' then text end ignore nulls) over past as instructions,
  sum(case when role = 'assistant' and turn % 4 = 0 then 1 else 0 end) over (partition by conv_id order by turn) as part
  from c window past as (partition by conv_id order by turn rows between unbounded preceding and 1 preceding)),
a as (select *, row_number() over (partition by conv_id, part order by turn) as calls from w where role = 'assistant')
"""


@query(ANSWERS + """select request_id, thread_id, case when conv_id // 3 <> conv_id then 'conv-' || (conv_id // 3) end as parent_thread_id,
  'completed' as status, 'm1' as model, 'high' as effort, 'resp_' || request_id as response_id, 6::bigint as frames, 1::bigint as text_deltas, 1::bigint as messages,
  input_bytes as input_tokens, strlen(text)::bigint as output_tokens, input_bytes // 2 as cached_tokens,
  case when input_bytes > 0 then (input_bytes // 2) / input_bytes end as cache_ratio from a""")
def turns_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return turns.assemble(_frames(spark, d)).select(
        "request_id", "thread_id", "parent_thread_id", "status", "model", "effort", "response_id", "frames", "text_deltas", "messages",
        "input_tokens", "output_tokens", "cached_tokens", "cache_ratio",
    )


@query(ANSWERS + """select thread_id, count(*) as responses, sum(input_bytes)::bigint as input_tokens, sum(strlen(text))::bigint as output_tokens from a group by 1""")
def thread_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(_frames(spark, d))
    return t.groupBy("thread_id").agg(F.count("*").alias("responses"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))


@query(ANSWERS + """select request_id, thread_id, strlen(text)::bigint as delta_sampled, calls = 1 as reset,
  row_number() over (partition by conv_id order by turn) = 1 as baseline_reset from a""")
def response_deltas(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(_frames(spark, d))
    out = timing.complete(turns.assemble(f), timing.timings(f))
    return out.select("request_id", "thread_id", F.col("delta_sampled_tokens").cast("long").alias("delta_sampled"), "reset", "baseline_reset")


EVENTS = "with e as (select *, (props::json->>'k')::bigint as k from events)"


@query(EVENTS + """, p as (select *, lag(k) over w as pk, lag(ts) over w as pt from e window w as (partition by user_id, event_type order by ts, event_id)),
r as (select *, pk is null or ts - pt > interval 1 day as cold from p)
select event_id, k - case when cold or k <= pk then 0 else pk end as delta_k, cold or k <= pk as reset, cold as baseline_reset from r""")
def counter_deltas(spark: SparkSession, d: str) -> DataFrame:
    out = deltas.counter_deltas(_events(spark, d).withColumn("calls", F.col("k")), ["user_id", "event_type"], ["ts", "event_id"], "calls", ["k"], "ts", "ts", "1 day")
    return out.select("event_id", "delta_k", "reset", "baseline_reset")


@query(EVENTS + """, p as (select *, k % 5 + 1 as n, lag(k % 5 + 1) over w as pn, lag(ts) over w as pt from e window w as (partition by user_id order by ts, event_id)),
r as (select *, case when pn is null or ts - pt > interval 1 day or pn > n then 0 else pn end as base from p)
select event_id, case when base < n then array_to_string(range(base + 1, n + 1), ',') end as fresh from r""")
def array_suffixes(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).withColumn("arr", F.sequence(F.lit(1).cast("long"), F.col("k") % 5 + 1))
    out = deltas.counter_deltas(e, ["user_id"], ["ts", "event_id"], "event_id", [], "ts", "ts", "1 day", array="arr")
    return out.select("event_id", F.array_join(F.transform("new_arr", lambda x: x.cast("string")), ",").alias("fresh"))


@query(EVENTS + """, p as (select *, lag(k) over w as pk from e window w as (partition by user_id order by ts, event_id))
select event_id, user_id || ':' || sum(case when pk is null or k <= pk then 1 else 0 end) over (partition by user_id order by ts, event_id) as logical_turn from p""")
def logical_turns(spark: SparkSession, d: str) -> DataFrame:
    e = deltas.counter_deltas(_events(spark, d), ["user_id"], ["ts", "event_id"], "k", [], "ts", "ts", "10000 days")
    out = deltas.logical_turns(e.withColumn("server", F.lit("")), "user_id", ["ts", "event_id"], "reset", "server")
    return out.select("event_id", "logical_turn")


@query("""with m as (select conv_id, max(turn) as last from conversations where role = 'assistant' group by 1)
select distinct 'conv-' || conv_id as thread_id, role, text as body from conversations join m using (conv_id)
where role in ('user', 'assistant') and turn < last and text <> ''""")
def prompts_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return content.prompts(_frames(spark, d)).select("thread_id", "role", "body")


@query(ANSWERS + "select request_id, thread_id, text as body from a")
def output_messages(spark: SparkSession, d: str) -> DataFrame:
    return content.messages(_frames(spark, d)).select("request_id", "thread_id", "body")


@query(ANSWERS + "select request_id, substr(sha256(instructions), 1, 16) as instructions_hash from a")
def instruction_hashes(spark: SparkSession, d: str) -> DataFrame:
    return turns.assemble(_frames(spark, d)).select("request_id", X.short_hash(F.col("instructions")).alias("instructions_hash"))


@query(EVENTS.replace("with e", "with recursive e") + """,
s as (select *, row_number() over (partition by user_id, k order by event_id) as rn from e where event_type in ('click', 'view')),
r as (select user_id, k, rn, event_id, event_type, ts, case when event_type = 'click' then [ts] else cast([] as timestamp[]) end as open,
    case when event_type = 'click' then [event_id] else cast([] as bigint[]) end as refs, case when event_type = 'view' then 'none' end as match, null::bigint as matched_ref
  from s where rn = 1
  union all
  select n.user_id, n.k, n.rn, n.event_id, n.event_type, n.ts,
    case when n.event_type = 'click' then list_append(live, n.ts) when len(live) = 1 then cast([] as timestamp[]) else live end,
    case when n.event_type = 'click' then list_append(lrefs, n.event_id) when len(live) = 1 then cast([] as bigint[]) else lrefs end,
    case when n.event_type = 'view' then case len(live) when 0 then 'none' when 1 then 'exact' else 'ambiguous' end end,
    case when n.event_type = 'view' and len(live) = 1 then lrefs[1] end
  from (select s.*, open[len(open) - len(f) + 1:] as live, refs[len(open) - len(f) + 1:] as lrefs
    from (select s.user_id, s.k, s.rn, s.event_id, s.event_type, s.ts, r.open, r.refs, list_filter(r.open, lambda x: x >= s.ts - interval 24 hours) as f
      from r join s on s.user_id = r.user_id and s.k = r.k and s.rn = r.rn + 1) s) n)
select user_id, k, event_id, match, matched_ref from r where event_type = 'view'""")
def call_output_match(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).withColumn("ref", F.col("event_id"))
    out = content.match_outputs(e.where("event_type = 'click'"), e.where("event_type = 'view'"), ["user_id", "k"], "event_id", "ts")
    return out.select("user_id", "k", F.col("ref").alias("event_id"), "match", "matched_ref")


@query(EVENTS + """select case when k % 2 = 0 then '' else 'req-' || event_id end as request_id, 'error' as status, 'rate_limit' as error_type, 'c' || k as error_code, 429 as error_status,
  event_id from e where event_type = 'error'""")
def error_frames(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).where("event_type = 'error'")
    rid = F.when(F.col("k") % 2 == 0, "").otherwise(F.concat(F.lit("req-"), F.col("event_id").cast("string")))
    body = F.struct(F.lit("rate_limit").alias("type"), F.concat(F.lit("c"), F.col("k").cast("string")).alias("code"))
    text = F.to_json(F.struct(F.lit("error").alias("type"), body.alias("error"), F.lit(429).alias("status_code")))
    payload = F.struct(text.alias("text"))
    raw = F.to_json(F.struct(rid.alias("request_id"), F.lit("http").alias("transport"), payload.alias("payload"), F.struct(F.lit("text").alias("frame_type")).alias("extra")))
    f = wire.decode(e.select(F.lit("f").alias("file"), F.col("event_id").alias("frame_seq"), raw.alias("raw")))
    alone = turns.loose(f).withColumn("request_id", F.concat(F.lit("frame-"), F.col("frame_seq").cast("string")))
    rows = turns.assemble(f).unionByName(turns.assemble(alone).withColumn("request_id", F.lit("")))
    return rows.select("request_id", "status", "error_type", "error_code", "error_status", F.col("first_seq.frame_seq").alias("event_id"))


@query("""select c_custkey, 'a' as family, 'primary' as "window", c_acctbal as used, c_custkey::double as reset from customer
union all select c_custkey, 'b', 'secondary', 0.0, null from customer where c_custkey % 2 = 0""")
def quota_headers(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    names = [F.lit(x) for x in ("X-A-Primary-Used-Percent", "x-a-primary-reset-after-seconds", "X-B-Secondary-Used-Percent", "other")]
    values = [F.col("c_acctbal").cast("string"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, "0").otherwise(""), F.lit("1")]
    out = turns.quota_windows(c.withColumn("h", F.map_from_arrays(F.array(*names), F.array(*values))), "c_custkey", "h")
    return out.select("c_custkey", "family", "window", "used", "reset")


@query("""with o as (select *, (o_custkey % 17)::varchar as v from orders), f as (select v, min((o_orderdate, o_orderkey)) as o from o group by v),
k as (select v from f order by o limit 5) select coalesce(k.v, '_other') as v, count(*) as n, sum(o_orderkey)::bigint as s from o left join k using (v) group by 1""")
def cardinality_cap(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("v", (F.col("o_custkey") % 17).cast("string"))
    return metrics.cap_values(o, "v", ["o_orderdate", "o_orderkey"], 5).groupBy("v").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("s"))


@query("""with f as (select o_custkey, count(*) as n, row_number() over (order by min((o_orderdate, o_orderkey))) as i from orders where o_custkey is not null group by 1)
select 'o_custkey' as field, count(*) filter (i <= 100) as "distinct", coalesce(sum(n) filter (i > 100), 0)::bigint as rejected from f""")
def cap_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return metrics.cap_report(o, "o_custkey", ["o_orderdate", "o_orderkey"], 100)


@query("""with b as (select l_returnflag, l_quantity as v, len(list_filter([1, 4, 16, 64, 256, 1024, 4096, 16384, 65536, 262144, 1048576, 4194304, 16777216, 67108864], lambda x: x < l_quantity)) as b from lineitem),
n as (select l_returnflag, b, count(*) as n from b group by all), k as (select distinct l_returnflag from b), g as (select * from k, range(15) r(b))
select l_returnflag, sum(coalesce(n, 0))::bigint as count, (select sum(v) from b where b.l_returnflag = g.l_returnflag) as sum, string_agg(coalesce(n, 0)::varchar, ',' order by g.b) as buckets
from g left join n using (l_returnflag, b) group by l_returnflag""")
def explicit_histogram(spark: SparkSession, d: str) -> DataFrame:
    h = metrics.histogram(table(spark, d, "lineitem"), ["l_returnflag"], F.col("l_quantity"), metrics.TOKEN_BOUNDS)
    return h.withColumn("buckets", F.array_join(F.transform("buckets", lambda x: x.cast("string")), ","))


@query("""with b as (select l_shipdate, l_returnflag, len(list_filter([1, 4, 16, 64, 256, 1024, 4096, 16384, 65536, 262144], lambda x: x < l_extendedprice)) as b from lineitem),
n as (select l_returnflag, b, count(*) as n from b group by all),
c as (select *, sum(n) over (partition by l_returnflag order by b) as hi, sum(n) over (partition by l_returnflag) * 0.9 as rank from n),
e as (select *, [0, 1, 4, 16, 64, 256, 1024, 4096, 16384, 65536, 262144, 262144] as edges from c where hi >= rank)
select l_returnflag, round(min_by(edges[b + 1] + (edges[b + 2] - edges[b + 1]) * (rank - (hi - n)) / n, b)::double, 6) as p90 from e group by 1""")
def histogram_quantile(spark: SparkSession, d: str) -> DataFrame:
    bounds = metrics.TOKEN_BOUNDS[:10]
    h = metrics.histogram(table(spark, d, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), bounds)
    return h.select("l_returnflag", F.round(metrics.quantile(F.col("buckets"), bounds, 0.9), 6).alias("p90"))


@query("select event_type, max_by(event_id, (ts, event_id)) as event_id from events group by 1")
def gauge_last(spark: SparkSession, d: str) -> DataFrame:
    return metrics.last_value(_raw_events(spark, d), ["event_type"], "event_id", ["ts", "event_id"])


@query("select epoch(date_trunc('hour', ts))::bigint as step, event_type, count(*) / 3600.0::double as rate from events group by all")
def counter_rate(spark: SparkSession, d: str) -> DataFrame:
    return metrics.rate(_raw_events(spark, d), "ts", "1 hour", 3600, ["event_type"]).withColumn("step", F.unix_seconds("step"))


@query("""select event_type, count(*) as increase, round(sum(value) / greatest(count(*), 1), 6) as mean, count(distinct user_id) as users
from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1""")
def range_increase(spark: SparkSession, d: str) -> DataFrame:
    e = _raw_events(spark, d).where("ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20'")
    mean = F.round(F.sum("value") / F.greatest(F.count("*"), F.lit(1)), 6)
    return e.groupBy("event_type").agg(F.count("*").alias("increase"), mean.alias("mean"), F.countDistinct("user_id").alias("users"))


@query("select l_partkey, count(*) as n, sum(l_quantity) as qty from lineitem group by 1 order by n desc, l_partkey limit 15")
def top_parts(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    return metrics.top(n, "n", 15, ["l_partkey"])


@query("""select epoch(date_trunc('day', ts))::bigint as step, event_type, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (partition by date_trunc('day', ts)), 6)::double as share
from events group by date_trunc('day', ts), event_type""")
def mix_share(spark: SparkSession, d: str) -> DataFrame:
    n = _raw_events(spark, d).groupBy(F.window("ts", "1 day").start.alias("step"), "event_type").agg(F.count("*").alias("n"))
    return metrics.share_of_step(n, "step", "n").select(F.unix_seconds("step").alias("step"), "event_type", "n", F.round("share", 6).alias("share"))


@query("""select n_name, count(*) as customers, round(100.0 * count(*) filter (c_mktsegment similar to '(AUTO|BUILD).*') / greatest(count(*), 1), 6)::double as share
from customer join nation on c_nationkey = n_nationkey group by 1""")
def label_share(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    hit = F.count_if(metrics.label_matches(F.col("c_mktsegment"), "(AUTO|BUILD).*"))
    return c.groupBy("n_name").agg(F.count("*").alias("customers"), F.round(100.0 * hit / F.greatest(F.count("*"), F.lit(1)), 6).alias("share"))


@query("""with p as (select event_type, date_trunc('day', ts) as step, count(*) as n from events group by all),
h as (select *, epoch(step)::bigint // 86400 - row_number() over (partition by event_type order by step) as i
  from p where n > (select count(*) / 150.0 from events))
select event_type, epoch(min(step))::bigint as begin, epoch(max(step))::bigint as last, count(*) as steps from h group by event_type, i having count(*) >= 2""")
def alert_intervals(spark: SparkSession, d: str) -> DataFrame:
    e = _raw_events(spark, d)
    p = e.groupBy("event_type", F.window("ts", "1 day").start.alias("step")).agg(F.count("*").alias("n"))
    limit = e.agg((F.count("*") / 150.0).alias("limit"))
    over = p.crossJoin(F.broadcast(limit)).withColumn("x", F.col("n") - F.col("limit"))  # one row
    out = metrics.breaches(over, ["event_type"], "step", 86400, "x", 0.0, 2)
    return out.select("event_type", F.unix_seconds("begin").alias("begin"), F.unix_seconds("last").alias("last"), "steps")


@query(EVENTS + """select event_type, count(*) filter (k % 2 = 0) as fast_n, count(*) filter (k % 2 = 1) as normal_n,
round(100 * (avg(value) filter (k % 2 = 1) - avg(value) filter (k % 2 = 0)) / avg(value) filter (k % 2 = 1), 6) as improvement
from e group by 1 having count(*) filter (k % 2 = 0) > 0 and count(*) filter (k % 2 = 1) > 0""")
def cohort_improvement(spark: SparkSession, d: str) -> DataFrame:
    fast, slow = F.col("k") % 2 == 0, F.col("k") % 2 == 1
    a, b = F.avg(F.when(fast, F.col("value"))), F.avg(F.when(slow, F.col("value")))
    g = _events(spark, d).groupBy("event_type").agg(F.count_if(fast).alias("fast_n"), F.count_if(slow).alias("normal_n"), F.round(100 * (b - a) / b, 6).alias("improvement"))
    return g.where("fast_n > 0 and normal_n > 0")


@query("""select epoch(date_trunc('day', ts))::bigint as step, len(list_filter([0.01, 0.02, 0.04, 0.08, 0.16, 0.32, 0.64, 1.28, 2.56, 5.12, 10.24, 20.48, 40.96, 81.92], lambda x: x < value)) as bucket, count(*) as n
from events where value is not null group by all""")
def bucket_heatmap(spark: SparkSession, d: str) -> DataFrame:
    e = _raw_events(spark, d).where("value is not null")
    b = metrics.bucket_of(F.col("value"), metrics.SECONDS_BOUNDS).cast("long")
    return e.groupBy(F.window("ts", "1 day").start.alias("w"), b.alias("bucket")).agg(F.count("*").alias("n")).select(F.unix_seconds("w").alias("step"), "bucket", "n")


@query("select o_orderpriority, count(*) filter (o_orderstatus = 'F') as f, count(*) filter (o_orderstatus = 'O') as o, count(*) filter (o_orderstatus = 'P') as p from orders group by 1")
def status_matrix(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return m.select("o_orderpriority", *[F.coalesce(s, F.lit(0)).alias(s.lower()) for s in "FOP"])


@query("""select role, count(*) as n, round(100.0 * count(*) filter (text <> '') / count(*), 6)::double as present, count(*) filter (regexp_matches(text, '(?i)the')) as hits
from conversations group by 1""")
def field_presence(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    return c.groupBy("role").agg(
        F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("text") != "") / F.count("*"), 6).alias("present"), F.count_if(F.regexp_like("text", F.lit("(?i)the"))).alias("hits")
    )


@query("select distinct source as label_value from documents where source is not null")
def label_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("source is not null").select(F.col("source").alias("label_value")).distinct()


@query("""with a as (select o_custkey, max_by((o_orderkey, o_orderstatus, o_totalprice), o_orderkey) as r from orders group by 1),
b as (select o_custkey % 100 as a, max_by((o_orderkey, o_orderstatus, o_totalprice), o_orderkey) as r from orders group by 1)
select c_custkey, coalesce(a.r, b.r)[2] as o_orderstatus, coalesce(a.r, b.r)[3] as o_totalprice, case when coalesce(a.r, b.r) is null then 'miss' else 'hit' end as outcome
from customer left join a on c_custkey = o_custkey left join b on c_nationkey + 200 * (c_custkey % 2) = b.a""".replace("[2]", "['o_orderstatus']").replace("[3]", "['o_totalprice']")
  .replace("max_by((o_orderkey, o_orderstatus, o_totalprice), o_orderkey)", "max_by({'o_orderstatus': o_orderstatus, 'o_totalprice': o_totalprice}, o_orderkey)"))
def enrichment_join(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") + 200 * (F.col("c_custkey") % 2)).alias("alias"))
    o = table(spark, d, "orders").withColumn("o_alias", F.col("o_custkey") % 100)
    out = enrich.attach(c, o, "c_custkey", "alias", "o_custkey", "o_alias", "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return out.select("c_custkey", "o_orderstatus", "o_totalprice", "outcome")


@query("""with r as (select *, row_number() over (partition by l_suppkey, l_returnflag order by l_shipdate desc, l_orderkey desc, l_linenumber desc) as rn from lineitem)
select l_suppkey, l_returnflag, l_quantity, 100 - l_quantity as headroom from r where rn = 1""")
def latest_usage(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")
    out = enrich.newest(rows, ["l_suppkey", "l_returnflag"], ["l_shipdate", "l_orderkey", "l_linenumber"])
    return out.select("l_suppkey", "l_returnflag", "l_quantity", (100 - F.col("l_quantity")).alias("headroom"))


@query("""with p as (select s_suppkey, n_regionkey as r_regionkey from supplier join nation on s_nationkey = n_nationkey where n_regionkey < 3)
select s_suppkey, r_regionkey, r_regionkey not in (select r_regionkey from p) or exists (select 1 from p where p.s_suppkey = s.s_suppkey and p.r_regionkey = r.r_regionkey) as eligible
from supplier s, region r""")
def key_eligibility(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    listed = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).where("n_regionkey < 3").select("s_suppkey", F.col("n_regionkey").alias("r_regionkey"))
    return enrich.eligibility(s.select("s_suppkey"), r.select("r_regionkey"), listed, "s_suppkey", "r_regionkey")


@query("""select o_orderkey, case when o_orderpriority is null or o_orderpriority = '' then 'not_requested' when o_orderstatus = 'P' then 'unknown'
when substr(o_orderpriority, 1, 1) = '1' then 'granted' else 'downgraded' end as outcome from orders""")
def tier_outcomes(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    actual = F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).otherwise("default"))
    return o.select("o_orderkey", enrich.tier_outcome(F.col("o_orderpriority"), actual).alias("outcome"))


@query(ANSWERS + """, m as (select conv_id, max(turn) as last from c where role = 'assistant' group by 1),
p as (select distinct conv_id, role, text from c join m using (conv_id) where role in ('user', 'assistant') and turn < last and text <> '')
select 'turn' as record_type, count(*) as n, null::bigint as bytes from a union all
select 'message', count(*), sum(strlen(text))::bigint from a union all select 'prompt', count(*), sum(strlen(text))::bigint from p""")
def log_records(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(_frames(spark, d))
    t = turns.assemble(f)
    ts = F.lit(None).cast("timestamp").alias("ts")
    m = content.messages(f).select("thread_id", ts, F.lit(1).alias("ordinal"), "body")
    p = content.prompts(f).select("thread_id", ts, F.lit(1).alias("ordinal"), "body")
    rows = fanout.log_rows(t, m, p)
    size = F.when(F.col("record_type") != "turn", F.octet_length("body"))
    return rows.groupBy("record_type").agg(F.count("*").alias("n"), F.sum(size).alias("bytes"))


@query(ANSWERS + """, s as (select 'turn' as name, request_id, thread_id, chr(0) as z from a union all select 'response', request_id, thread_id, chr(0) from a)
select substr(sha256('thread' || z || thread_id), 1, 32) as trace_id, substr(sha256(name || z || request_id || z || '0'), 33, 16) as span_id,
  case when name = 'response' then substr(sha256('turn' || z || request_id || z || '0'), 33, 16) end as parent_span_id,
  case name when 'turn' then 'turn' else 'response m1' end as name, 'ok' as state from s""")
def span_tree(spark: SparkSession, d: str) -> DataFrame:
    return fanout.spans(turns.assemble(_frames(spark, d))).select("trace_id", "span_id", "parent_span_id", "name", "state")


@query("""with p as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest([{'i': 0, 'phase': 'queue', 'ms': l_quantity}, {'i': 1, 'phase': 'work', 'ms': l_tax * 100}, {'i': 2, 'phase': 'send', 'ms': l_discount * 100}]) as p from lineitem),
q as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, p.i as i, p.phase as phase, p.ms as ms from p where p.ms > 0)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, phase, round(sum(ms) over (partition by l_orderkey, l_linenumber, l_partkey, l_suppkey order by i), 6) as end_ms from q""")
def phase_spans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumns({"work": F.col("l_tax") * 100, "send": F.col("l_discount") * 100})
    out = fanout.phases(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "l_shipdate", {"queue": "l_quantity", "work": "work", "send": "send"})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "phase", F.round("end_ms", 6).alias("end_ms"))


@query(ANSWERS + """select request_id, substr(sha256(coalesce(instructions, '')), 1, 16) as version, text as answer,
greatest(input_bytes, strlen(text)) > 0 as has_usage, null::varchar as call_error from a""")
def generation_records(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(_frames(spark, d))
    m = content.with_ordinal(content.messages(f).withColumn("role", F.lit("assistant")), ["request_id", "instance"], ["file", "frame_seq"])
    p = content.with_ordinal(content.prompts(f), ["request_id", "instance"], ["file", "frame_seq", "pos"])
    g = fanout.generations(turns.assemble(f), p, m)
    return g.select("request_id", "version", F.get(F.col("output"), F.lit(0))["text"].alias("answer"), F.col("usage").isNotNull().alias("has_usage"), "call_error")


THREADS = """t as (select conv_id as node, case when conv_id // 3 <> conv_id then conv_id // 3 end as parent from conversations group by 1),
r as (select node, node as ancestor, 0 as depth from t union all
  select r.node, p.parent, r.depth + 1 from r join t p on p.node = r.ancestor join t q on q.node = p.parent)"""


def _threads(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("node")).distinct()
    return c.withColumn("parent", F.expr("nullif(node div 3, node)"))


@query("with recursive " + THREADS + """ select t.node, (select max_by(ancestor, depth) from r where r.node = t.node) as root, (select max(depth) from r where r.node = t.node) as depth,
(select count(*) from r where r.ancestor = t.node and depth > 0) as descendants, t.parent is not null and t.parent not in (select node from t) as orphaned from t""")
def thread_forest(spark: SparkSession, d: str) -> DataFrame:
    return threads.forest(_threads(spark, d), "node", "parent")


@query("with recursive " + THREADS + " select distinct ancestor as node from r where node % 10 = 7")
def retained_threads(spark: SparkSession, d: str) -> DataFrame:
    return threads.retained(_threads(spark, d), "node", "parent", F.col("node") % 10 == 7)


@query("""with n as (select o_custkey, o_orderpriority, count(*) as votes from orders group by all),
r as (select *, row_number() over (partition by o_custkey order by votes desc, o_orderpriority) as rn from n) select o_custkey, o_orderpriority, votes from r where rn = 1""")
def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return threads.majority(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority")


@query("""with recursive s as (select conv_id, turn, length(coalesce(text, ''))::bigint as n, row_number() over (partition by conv_id order by turn) as rn from conversations),
r as (select conv_id, turn, n, rn, 0 as chunk, n as used from s where rn = 1 union all
  select s.conv_id, s.turn, s.n, s.rn, r.chunk + case when r.used > 0 and r.used + s.n > 1500 then 1 else 0 end, case when r.used > 0 and r.used + s.n > 1500 then s.n else r.used + s.n end
  from r join s on s.conv_id = r.conv_id and s.rn = r.rn + 1)
select conv_id, turn, chunk, n from r""")
def digest_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return threads.pack_chunks(c, ["conv_id"], "turn", "n", 1500)


@query(ANSWERS + """, m as (select max(1700000000 + conv_id * 3600 + turn) as now from a)
select thread_id, count(*) as turns, sum(input_bytes)::bigint as input_tokens, min(1700000000 + conv_id * 3600 + turn)::bigint as first_seen, max(1700000000 + conv_id * 3600 + turn)::bigint as last_seen,
(select now from m) - max(1700000000 + conv_id * 3600 + turn) > 300 as quiet from a group by thread_id""")
def thread_rollup(spark: SparkSession, d: str) -> DataFrame:
    t = turns.assemble(_frames(spark, d))
    now = t.agg(F.max(F.unix_seconds("last_ts")).alias("now"))
    g = t.groupBy("thread_id").agg(
        F.count("*").alias("turns"), F.sum("input_tokens").alias("input_tokens"), F.min(F.unix_seconds("first_ts")).alias("first_seen"), F.max(F.unix_seconds("last_ts")).alias("last_seen")
    )
    return g.crossJoin(F.broadcast(now)).withColumn("quiet", F.col("now") - F.col("last_seen") > 300).drop("now")  # one row


@query(ANSWERS + "select request_id, thread_id from a where contains(request_id, '_7_') or regexp_matches(request_id, '7$')")
def id_lookup(spark: SparkSession, d: str) -> DataFrame:
    lines = wire.render(table(spark, d, "conversations"))
    f = wire.lookup(lines, F.regexp_like("raw", F.lit('"request_id":"ws_(7_[0-9]+|[0-9]+_[0-9]*7)"')))
    return turns.assemble(f).select("request_id", "thread_id")


# Paths of a table of flat documents, from the documents.
PATHS = """with d as (select event_type as kind, props::json as j from events), w as (select kind, '' as path, json_type(j) as t from d union all select kind, k, json_type(json_extract(j, '$.' || k)) from (select kind, j, unnest(json_keys(j)) as k from d)),
s as (select kind, path, case when t in ('UBIGINT', 'BIGINT', 'DOUBLE') then 'number' when t = 'VARCHAR' then 'string' when t = 'BOOLEAN' then 'bool' else lower(t) end as json_type, count(*) as n from w group by all)
"""


@query(PATHS + "select * from s")
def induced_paths(spark: SparkSession, d: str) -> DataFrame:
    return profile.induce(profile.paths(_raw_events(spark, d), "event_type", "props"))


@query("""with j as (select conv_id % 3 as kind, role, count(*) as n from conversations group by all) select kind::varchar as kind, 'role' as path, role as value, n, false as capped from j""")
def path_values(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").select((F.col("conv_id") % 3).cast("string").alias("kind"), F.to_json(F.struct("role", "turn")).alias("doc"))
    return profile.value_counts(profile.paths(c, "kind", "doc"))


@query(PATHS + """, b as (select * from s where kind <> 'purchase'), n as (select * from s where kind <> 'click')
select case when exists (select 1 from b k where k.kind = n.kind and k.path = n.path) and json_type <> 'null' then 'breaking' else 'new' end as severity,
  case when not exists (select 1 from b k where k.kind = n.kind and k.path = n.path) then 'path' when json_type = 'null' then 'nullable' else 'type' end as what, kind, path, json_type from n anti join b using (kind, path, json_type)
union all select 'info', 'absent', kind, path, json_type from b anti join n using (kind, path, json_type)""")
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    sig = profile.induce(profile.paths(_raw_events(spark, d), "event_type", "props"))
    return profile.drift(sig.where("kind <> 'purchase'"), sig.where("kind <> 'click'"))


@query(ANSWERS + """, h as (select distinct date_trunc('hour', to_timestamp(1700000000 + conv_id * 3600 + turn)::timestamp) as h from a),
b as (select min(h) + interval 5 hours as lo, min(h) + interval 20 hours as hi from h)
select strftime(h, '%Y-%m-%dT%H') || '.jsonl.gz' as file from h, b where h <= hi + interval 1 hour and h + interval 1 hour >= lo - interval 1 hour""")
def archives_in_window(spark: SparkSession, d: str) -> DataFrame:
    files = wire.render(table(spark, d, "conversations")).select("file").distinct()
    first = files.agg(F.min(wire.archive_hour(F.col("file"))).alias("h"))
    low, high = F.col("h") + F.expr("interval 5 hours"), F.col("h") + F.expr("interval 20 hours")
    return files.crossJoin(F.broadcast(first)).where(wire.in_window(F.col("file"), low, high)).select("file")  # one row


@query("""with r as (select p_partkey as name, p_size as size, case when p_partkey % 7 = 0 then 'z' else p_brand end as fingerprint from part),
l as (select p_partkey as name, case when p_partkey % 2 = 0 then p_size - 1 else p_size end as size, p_brand as fingerprint from part where p_partkey % 5 > 0)
select r.name, case when l.name is null then 'new' when l.fingerprint <> r.fingerprint then 'replaced' when r.size > l.size then 'grown' else 'current' end as action from r left join l using (name)""")
def inventory_actions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_size").alias("size"), F.col("p_brand").alias("fingerprint"))
    local = p.where("name % 5 > 0").withColumn("size", F.when(F.col("name") % 2 == 0, F.col("size") - 1).otherwise(F.col("size")))
    return wire.reconcile(p.withColumn("fingerprint", F.when(F.col("name") % 7 == 0, "z").otherwise(F.col("fingerprint"))), local)


@query("""select conv_id, turn, regexp_replace(text, '[0-9]+', 'N', 'g') as masked, substr(sha256(text), 1, 16) as hash,
case when length(text) > 100 then substr(text, 1, 60) || '…[' || (length(text) - 100) || ' chars elided]…' || right(text, 40) else text end as cut,
case when coalesce(text, '') = '' then -1 else floor(log10(length(text)))::int end as magnitude from conversations""")
def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    c, t = table(spark, d, "conversations"), F.col("text")
    return c.select("conv_id", "turn", X.digit_mask(t).alias("masked"), X.short_hash(t).alias("hash"), X.head_tail(t, 60, 40).alias("cut"), X.magnitude(F.length(t)).alias("magnitude"))


@query("select epoch(date_trunc('hour', ts))::bigint as step, event_type, count(*) as n from events group by all")
def streamed_counts(spark: SparkSession, d: str) -> DataFrame:
    stream = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/event[s].parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    hours = stream.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("step"), "event_type", "n")
    return jobs.drain(hours, shared_dir(spark), "complete").select(F.unix_seconds("step").alias("step"), "event_type", "n")
