"""Reduction, correlation, metric and forest operators on small tables, against plain loops."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from turnlake.operators import content, deltas, enrich, fanout, metrics, profile, registry, threads, turns
from turnlake.sources import frames as wire
from turnlake.streaming import jobs

T0 = datetime(2026, 1, 1)


def simulate(rows, gap):
    base, out = {}, []
    for i, key, calls, value, ts in rows:
        b = base.get(key)
        cold = b is None or ts - b[2] > gap
        reset = cold or calls is None or calls <= b[0]
        out.append((i, (value or 0) - (0 if reset else b[1]), reset, cold))
        if calls is not None:
            base[key] = (calls, value or 0, ts)
    return out


def test_deltas_equal_a_sequential_fold(spark):
    rnd = random.Random(1)
    rows, ts = [], T0
    for i in range(600):
        ts += timedelta(minutes=rnd.choice([1, 5, 50]))
        rows.append((i, f"s{rnd.randrange(4)}", rnd.choice([None, 1, 2, 3, 4, 5]), rnd.choice([None, *range(9)]), ts))
    df = spark.createDataFrame(rows, "i long, s string, calls long, v long, ts timestamp")
    got = deltas.counter_deltas(df, ["s"], ["i"], "calls", ["v"], "ts", "ts", "30 minutes")
    assert sorted((r["i"], r["delta_v"], r["reset"], r["baseline_reset"]) for r in got.collect()) == simulate(rows, timedelta(minutes=30))


def test_matches_consume_and_age(spark):
    at = lambda h: T0 + timedelta(hours=h)
    calls = [("t", "c", 1, at(0), 1), ("t", "c", 4, at(5), 4), ("t", "c", 5, at(6), 5), ("t", "d", 1, at(0), 1)]
    outputs = [("t", "c", 2, at(1), 2), ("t", "c", 3, at(2), 3), ("t", "c", 6, at(7), 6), ("t", "d", 9, at(30), 9), ("u", "c", 2, at(1), 2)]
    make = lambda rows: spark.createDataFrame(rows, "thread string, id string, o long, ts timestamp, ref long")
    got = {(r["thread"], r["id"], r["ref"]): (r["match"], r["matched_ref"]) for r in content.match_outputs(make(calls), make(outputs), ["thread", "id"], "o", "ts").collect()}
    assert got == {("t", "c", 2): ("exact", 1), ("t", "c", 3): ("none", None), ("t", "c", 6): ("ambiguous", None), ("t", "d", 9): ("none", None), ("u", "c", 2): ("none", None)}


def test_caps_buckets_and_quantiles(spark):
    df = spark.createDataFrame([(i, v, float(x)) for i, (v, x) in enumerate([("b", 1), ("a", 2), ("", 4), ("c", 5), ("b", 100), (None, 3)])], "i long, f string, x double")
    got = [r["f"] for r in metrics.cap_values(df, "f", ["i"], 2).orderBy("i").collect()]
    assert got == ["b", "a", "", "_other", "b", None] and metrics.cap_report(df, "f", ["i"], 2).first().asDict() == {"field": "f", "distinct": 2, "rejected": 1}
    again = metrics.cap_report(df.union(df), "f", ["i"], 1).first()
    assert (again["distinct"], again["rejected"]) == (1, 4)  # rows, not values
    h = metrics.histogram(df, [], F.col("x"), (1.0, 4.0, 16.0)).first()
    assert h["buckets"] == [1, 3, 1, 1] and h["count"] == 6
    q = lambda p: spark.createDataFrame([([1, 3, 1, 1],)], "b array<long>").select(metrics.quantile(F.col("b"), (1.0, 4.0, 16.0), p)).first()[0]
    assert q(0.5) == 3.0 and q(1.0) == 16.0 and abs(q(0.1) - 0.6) < 1e-9
    a = spark.range(1).select(metrics.stable(metrics.only(metrics.attributes(b=F.lit("x"), a=F.lit(1), c=F.lit("")), ["a", "b", "c"]))).first()[0]
    assert a == "a=1,b=x"


def test_alert_needs_consecutive_steps(spark):
    rows = [("k", T0 + timedelta(minutes=m), v) for m, v in [(0, 9.0), (1, 9.0), (2, 1.0), (3, 9.0), (4, 9.0), (5, 9.0)]]
    got = metrics.breaches(spark.createDataFrame(rows, "k string, step timestamp, v double"), ["k"], "step", 60, "v", 5.0, 3).collect()
    assert [(r["steps"], r["begin"]) for r in got] == [(3, T0 + timedelta(minutes=3))]


def test_forest_with_orphans_and_chains(spark):
    rows = [(i, i - 1 if i else None) for i in range(40)] + [(100, 999), (101, 100), (200, 200)]
    got = {r["node"]: r for r in threads.forest(spark.createDataFrame(rows, "node long, parent long"), "node", "parent").collect()}
    assert got[39]["root"] == 0 and got[39]["depth"] == 39 and got[0]["descendants"] == 39
    assert got[100]["orphaned"] and got[101]["root"] == 100 and not got[101]["orphaned"] and got[200]["depth"] == 0
    kept = threads.retained(spark.createDataFrame(rows, "node long, parent long"), "node", "parent", F.col("node") == 3).collect()
    assert sorted(r["node"] for r in kept) == [0, 1, 2, 3]


def test_chunks_never_split_a_block(spark):
    df = spark.createDataFrame([("t", i, n) for i, n in enumerate([5, 5, 11, 1, 9, 1])], "t string, o long, n long")
    got = [(r["o"], r["chunk"]) for r in threads.pack_chunks(df, ["t"], "o", "n", 10).orderBy("o").collect()]
    assert got == [(0, 0), (1, 0), (2, 1), (3, 2), (4, 2), (5, 3)]


def test_enrichment_prefers_the_newest_row_of_the_key(spark):
    t = spark.createDataFrame([("r1", "a1"), ("r2", "a2"), ("r3", "a3"), (None, None)], "id string, alias string")
    logs = spark.createDataFrame([(1, "r1", "z", 1.0), (2, "r1", "z", None), (3, "q", "a2", 5.0)], "n long, rid string, arch string, cost double")
    got = {r["id"]: (r["cost"], r["outcome"]) for r in enrich.attach(t, logs, "id", "alias", "rid", "arch", "n", ["cost"]).collect()}
    assert got == {"r1": (None, "hit"), "r2": (5.0, "hit"), "r3": (None, "miss"), None: (None, "miss")}


def test_drift_severities(spark):
    base = spark.createDataFrame([("e", "a", "string", 1), ("e", "b", "number", 1), ("e", "gone", "bool", 1)], "kind string, path string, json_type string, n long")
    now = spark.createDataFrame([("e", "a", "string", 2), ("e", "a", "null", 1), ("e", "b", "string", 1), ("f", "x", "object", 1)], "kind string, path string, json_type string, n long")
    got = sorted((r["severity"], r["what"], r["path"], r["json_type"]) for r in profile.drift(base, now).collect())
    assert got == [("breaking", "type", "b", "string"), ("info", "absent", "b", "number"), ("info", "absent", "gone", "bool"), ("new", "nullable", "a", "null"), ("new", "path", "x", "object")]
    assert {r["severity"]: r["n"] for r in profile.severity_counts(profile.drift(base, base)).collect()} == {"breaking": 0, "new": 0, "info": 0}


def test_walk_and_sampling(spark):
    df = spark.createDataFrame([("e", '{"a":[1,{"b":null}],"c":{"d":true}}'), ("e", "{bad"), ("e", None)], "kind string, doc string")
    got = {(r["path"], r["json_type"]): r["n"] for r in profile.induce(profile.paths(df, "kind", "doc", frozenset({"c"}))).collect()}
    assert got == {("", "object"): 1, ("a", "array"): 1, ("a[]", "number"): 1, ("a[]", "object"): 1, ("a[].b", "null"): 1, ("c", "object"): 1, ("", "undecodable"): 2}
    n = spark.range(100).withColumn("k", F.lit("x"))
    assert profile.head_and_stride(n, "k", ["id"], 10, 9).count() == 20


def test_phases_bodies_and_lateness(spark):
    df = spark.createDataFrame([("t", 5.0, 0.0, 7.0)], "t string, a double, b double, c double")
    got = [(r["phase"], r["offset_ms"], r["end_ms"]) for r in fanout.phases(df, ["t"], "a", {"p": "a", "q": "b", "r": "c"}).orderBy("offset_ms").collect()]
    assert got == [("p", 0.0, 5.0), ("r", 5.0, 12.0)]
    cut = fanout.fit_body(spark.createDataFrame([("é" * 10,), ("ok",)], "body string"), "body", 5).collect()
    assert [(r["body"], r["full_bytes"]) for r in cut] == [("éé", 20), ("ok", None)]
    rows = spark.createDataFrame([(T0,), (T0 - timedelta(hours=4),)], "ts timestamp")
    young, late = fanout.drop_late(rows, "ts", F.lit(T0))
    assert young.count() == 1 and late.first()["too_old"] == 1


def test_inventory(spark):
    remote = spark.createDataFrame([("a", 1, "x"), ("b", 5, "x"), ("c", 1, "y"), ("d", 1, "x")], "name string, size long, fingerprint string")
    local = spark.createDataFrame([("b", 3, "x"), ("c", 1, "x"), ("d", 1, "x")], "name string, size long, fingerprint string")
    assert {r["name"]: r["action"] for r in wire.reconcile(remote, local).collect()} == {"a": "new", "b": "grown", "c": "replaced", "d": "current"}
    files = spark.createDataFrame([("2026-01-01T00.jsonl.gz", True), ("2026-01-02T00.jsonl.gz", False), ("2026-02-01T00.jsonl.gz", True)], "name string, read_all boolean")
    assert [r["name"] for r in wire.removable(files, F.lit(T0 + timedelta(days=60)), 30).collect()] == ["2026-01-01T00.jsonl.gz"]


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i, i % 3, (i * 7) % 11, T0 + timedelta(minutes=i)) for i in range(90)]
    df = spark.createDataFrame(rows, "i long, s long, v long, ts timestamp")
    for n, part in enumerate([df.where("i < 40"), df.where("i >= 40")]):
        part.coalesce(1).write.parquet(str(tmp_path / "in" / f"p{n}"))
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = jobs.drain(jobs.series_deltas(stream().withColumn("calls", F.col("v")), ["s"], "i", "calls", ["v"], "ts"), str(tmp_path)).collect()
    batch = deltas.counter_deltas(df.withColumn("calls", F.col("v")), ["s"], ["i"], "calls", ["v"], "ts", "ts", "1000 days").collect()
    assert sorted((r["s"], r["i"], r["delta_v"]) for r in got) == sorted((r["s"], r["i"], float(r["delta_v"])) for r in batch)
    seen = jobs.drain(jobs.first_seen(stream(), "ts", ["v"]), str(tmp_path)).collect()
    assert sorted(r["v"] for r in seen) == list(range(11))


def test_long_groups_stream(spark):
    n, day = 100_000, 86_400
    blocks = spark.range(n).selectExpr("0 as t", "id as o", "3L as n")
    got = threads.pack_chunks(blocks, ["t"], "o", "n", 10).groupBy("chunk").count().groupBy("count").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [(1, 1), (3, n // 3)]
    make = lambda shift: spark.range(n).selectExpr("0 as t", f"id * 2 + {shift} as o", f"timestamp_seconds(id * 2 + {shift}) as ts", f"id * 2 + {shift} as ref")
    calls, outputs = make(0), make(1)
    got = content.match_outputs(calls, outputs, ["t"], "o", "ts").where("match = 'exact' and matched_ref = ref - 1").count()
    assert got == n
    got = content.match_outputs(calls.where(f"ref < {day}"), outputs.where(f"ref > {day}"), ["t"], "o", "ts").groupBy("match").count().collect()
    assert {r[0] for r in got} == {"ambiguous", "exact", "none"} and sum(r[1] for r in got) == n - day // 2


def test_registry_reports_what_it_skips_and_buckets_negative_gaps(spark):
    gaps = spark.createDataFrame([("m", -20_000.0, 1), ("m", -30.0, 2), ("m", -2.0, 3), ("m", 2.0, 4), ("m", 0.0, 5)], "model string, tbt_gap_ms double, o int")
    with pytest.warns(UserWarning, match="turns lacks request_kind, status"):
        rows = registry.points(gaps, "o", ["o"])
    r = registry.aggregate(rows.where("metric = 'time_between_tokens_gap'")).first()
    assert r["count"] == 4 and [i for i, n in enumerate(r["buckets"]) if n] == [0, 8, 11, 14] and len(r["buckets"]) == 26
    lines = wire.render(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string"))
    done = turns.assemble(wire.decode(lines))
    skipped = registry.missing(done.columns)
    runs = [m.name for m in registry.METRICS if m.name not in skipped]
    assert skipped["cost_usd"] == ["cost_usd"] and "turns" not in skipped and "attributes_rejected" not in skipped
    with pytest.warns(UserWarning):
        got = {r["metric"] for r in registry.points(done, "first_ts", ["first_seq"]).collect()}
    assert {"responses", "tokens_output"} <= got <= set(runs)
    print("RUNS", runs)


@pytest.mark.parametrize(("parts", "held", "small"), [(1, 10**6, 10**6), (6, 10**6, 10**6), (6, 50, 10**6), (6, 10**6, 0)])
def test_frequent_values_are_exact_however_rows_are_spread(spark, parts, held, small):
    rng = random.Random(3)
    rows = [("a", "id", f"i{k}", 1) for k in range(400)] + [("a", "id", v, 1) for v in ("x", "y", "y") for _ in range(60)] + [(None, "few", f"f{k % 9}", 1 + k % 3) for k in range(60)]
    rows += [("b", "zipf", f"z{int(rng.paretovariate(0.7))}", rng.randint(1, 3)) for _ in range(900)] + [("b", "nothing", None, 5), ("b", "exact", "v", 7)] + [("b", "twenty", f"t{k}", 1) for k in range(20)]
    rng.shuffle(rows)
    counts = Counter()
    for kind, path, value, n in rows:
        if value is not None:
            counts[kind, path, value] += n
    expected = set()
    for kind, path in {k[:2] for k in counts}:
        mine = {v: n for (k, p, v), n in counts.items() if (k, p) == (kind, path)}
        kept = mine if len(mine) <= 20 else {v: n for v, n in mine.items() if n * 20 > sum(mine.values())}
        expected |= {(kind, path, v, n, len(mine) > 5) for v, n in sorted(kept.items(), key=lambda x: (-x[1], x[0]))[:5]}
    walked = spark.createDataFrame(rows, "kind string, path string, value string, n long").repartition(parts)
    assert {tuple(r) for r in profile.frequent_values(walked, 5, 20, held, small).collect()} == expected
    assert profile.frequent_values(walked.limit(0), 5, 20).count() == 0


def test_labels_derived_from_several_columns(spark):
    rows = [("error", None, None, 2, 1000, "subagent", "b", {"x-a-limit-name": "c", "x-b-limit-name": "a", "x-c-limit-name": ""}), ("completed", "", "late", 0, 1012, "user", "", None), ("completed", None, "", None, None, None, None, {})]
    df = spark.createDataFrame(rows, "status string, type string, code string, errors int, close int, source string, active string, headers map<string, string>")
    c = F.col
    got = df.select(metrics.failure(c("status"), c("type"), c("code")), metrics.frame_class(c("errors"), c("close")), metrics.agent_identity(c("source")), metrics.quota_names(c("active"), c("headers"))).collect()
    assert [tuple(r) for r in got] == [("sdk_error", "error", "codex/subagent", "a,b,c"), ("sdk_error", "close", "codex", ""), (None, None, "codex", "")]


def test_digest_plan_counts_calls_of_sessions_and_the_whole(spark):
    from turnlake.operators import reports

    units = spark.createDataFrame([("a", 10, 1), ("b", 20, 3), ("c", 5, 2), ("d", 7, 1), ("x", 1, 1)], "node string, chars long, passes long")
    trees = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("d", "c"), ("x", None)], "node string, root string")
    got = {r["session"]: tuple(r)[1:] for r in reports.digest_plan(units, trees).collect()}
    assert got == {"a": (30, 1, 1, 6), "c": (12, 2, 1, 5), None: (42, 3, 2, 12)}
    assert [tuple(r) for r in reports.digest_plan(units.limit(0), trees).collect()] == [(None, 0, 0, 0, 1)]


def test_the_registry_sorts_gauges_only_and_compiles_its_cells(spark):
    made = [registry.Metric("n", "counter", "v", "v > 0", ("b", "a")), registry.Metric("h", "histogram", "cast(v as double)", "v is not null", ("a",), (1.0, 2.0)), registry.Metric("g", "gauge", "cast(v as double)", "true", ("a",))]
    rows = registry.points(spark.createDataFrame([("x", "y", 1, 1), ("x", None, 2, 2), ("", "y", 3, 3), ("x", "y", None, 4), ("x", "y", 2, 0)], "a string, b string, v int, o int"), "o", ["o"], made)
    got = registry.aggregate(rows, made)
    assert sorted((r["metric"], r["labels"], r["value"], r["count"], r["buckets"]) for r in got.collect()) == [
        ("g", "", 3.0, 1, None), ("g", "a=x", 2.0, 3, None), ("h", "", 3.0, 1, [0, 0, 1]), ("h", "a=x", 5.0, 3, [1, 2, 0]),
        ("n", "a=x", 2.0, 1, None), ("n", "a=x,b=y", 3.0, 2, None), ("n", "b=y", 3.0, 1, None),
    ]
    assert sorted(r["labels"] for r in registry.aggregate(rows.drop("labels"), made).collect()) == sorted(r["labels"] for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[metric" in plan and "lambdafunction" not in plan.lower()
