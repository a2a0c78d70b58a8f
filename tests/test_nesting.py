"""Intervals of span trees, against walks over them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from turnlake.operators import nesting

SPANS = "trace_id string, span_id string, parent_span_id string, name string, start long, end long, state string, attrs map<string, string>"


def forest(seed, shape):
    """Rows of some traces, and of each span its ancestors from the root down."""
    rng, rows = random.Random(seed), []
    for t in range(3):
        ids = [f"s{i:02d}" for i in range(rng.randint(1, 30))]
        for i, sid in enumerate(ids):
            parent = None if i == 0 else {"random": rng.choice([*ids[:i], "gone"]), "chain": ids[i - 1], "star": ids[0]}[shape]
            rows.append((f"t{t}", sid, parent, rng.choice("abc"), rng.randint(0, 5), 9, "ok", {"k": "v"}))
    return rows


def walked(rows):
    by_id = {(r[0], r[1]): r for r in rows}
    children = {}
    for r in rows:
        known = (r[0], r[2]) in by_id
        children.setdefault((r[0], r[2] if known else None), []).append(r)
    out, line = {}, {}

    def visit(trace, sid, above):
        for r in sorted(children.get((trace, sid), []), key=lambda r: (r[4], r[1])):
            enter = sum(k[0] == trace for k in line)
            line[trace, r[1]] = [*above, r[1]]
            visit(trace, r[1], line[trace, r[1]])
            out[trace, r[1]] = (sid, len(above), enter, sum(k[0] == trace for k in line) - 1)

    for t in {r[0] for r in rows}:
        visit(t, None, [])
    return by_id, out, line


@pytest.mark.parametrize(("seed", "shape"), [(1, "random"), (2, "chain"), (3, "star")])
def test_intervals_and_relations_equal_walks(spark, seed, shape):
    rows = forest(seed, shape)
    by_id, expected, line = walked(rows)
    given = [*rows, rows[1][:4] + (99, 99, "later", None)] if len(rows) > 1 else rows  # a repeated span: the first one counts
    n = nesting.intervals(spark.createDataFrame(given, SPANS).withColumn("_extra", F.lit(1))).persist()
    assert {(r["trace_id"], r["span_id"]): (r["parent"], r["depth"], r["enter"], r["leave"]) for r in n.collect()} == expected
    name = {k: r[3] for k, r in by_id.items()}
    above = {k: [a for a in v[:-1] if name[k[0], a] == "a"] for k, v in line.items()}
    got = {(r["trace_id"], r["span_id"]): (r["ancestor"], r["levels"]) for r in nesting.under(n, F.col("name") == "a", F.col("name") != "c").collect()}
    assert got == {k: (v[0], expected[k][1] - expected[k[0], v[0]][1]) for k, v in above.items() if v and name[k] != "c"}
    below = {k: sum(k[0] == j[0] and k[1] in v[:-1] and name[j] == "b" for j, v in line.items()) for k in line}
    got = {(r["trace_id"], r["span_id"]): r["n"] for r in nesting.over(n, F.col("name") != "c", F.col("name") == "b").collect()}
    assert got == {k: v for k, v in below.items() if v and name[k] != "c"}
    near = {k: sum(j != k and j[0] == k[0] and expected[j][0] == expected[k][0] and name[j] in "ab" for j in line) for k in line}
    got = {(r["trace_id"], r["span_id"]): r["n"] for r in nesting.beside(n, F.col("name") == "a", F.col("name") != "c").collect()}
    assert got == {k: v for k, v in near.items() if v and name[k] == "a"}


def test_rows_without_a_place_are_left_out(spark):
    rows = [("t", "a", None, "x", 0, 1, "ok", None), ("t", "b", "c", "x", 0, 1, "ok", None), ("t", "c", "b", "x", 0, 1, "ok", None), ("t", "d", "b", "x", 0, 1, "ok", None), (None, "e", None, "x", 0, 1, "ok", None), ("t", None, "a", "x", 0, 1, "ok", None), ("t", "f", "f", None, None, None, None, None)]
    n = nesting.intervals(spark.createDataFrame(rows, SPANS))
    assert sorted((r["span_id"], r["depth"], r["enter"], r["leave"]) for r in n.collect()) == [("a", 0, 1, 1), ("f", 0, 0, 0)]
    empty = nesting.intervals(spark.createDataFrame([], SPANS))
    assert empty.count() == 0 and nesting.under(empty, F.lit(True), F.lit(True)).count() == 0 and nesting.over(empty, F.lit(True), F.lit(True)).count() == 0


def test_running_folds_over_one_large_key(spark):
    rows = spark.range(5000).select(F.lit("k").alias("key"), (F.col("id") * 7919 % 5000).alias("at"), (F.col("id") % 13).alias("v")).repartition(6)
    got = {r["at"]: (r["s"], r["m"]) for r in nesting.before(nesting.before(rows, ["key"], ["at"], F.col("v"), "s"), ["key"], ["at"], F.when(F.col("v") < 12, F.col("v")), "m", F.max).collect()}
    v, total, most = {i * 7919 % 5000: i % 13 for i in range(5000)}, None, None
    for at in range(5000):
        assert got[at] == (total, most)
        total, most = (total or 0) + v[at], max(most or 0, v[at]) if v[at] < 12 else most
