"""Several tables of a batch appear together or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from turnlake.sources.tables import committed, write_batch
from turnlake.streaming import jobs


def seen(spark, folder, name):
    return sorted(r[0] for r in committed(spark, folder, name, "id long").collect())


def test_a_batch_is_seen_whole_once_or_not_at_all(spark, tmp_path):
    folder, ids = str(tmp_path / "out"), lambda a, b: spark.range(a, b)
    assert seen(spark, folder, "x") == [] and not write_batch({}, folder, 0)
    assert write_batch({"x": ids(0, 3), "y": ids(10, 12)}, folder, 0)
    with pytest.raises(Exception, match="lost"):
        write_batch({"x": ids(3, 6), "y": ids(12, 14).select(F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("long").alias("id"))}, folder, 1)
    assert seen(spark, folder, "x") == [0, 1, 2] and seen(spark, folder, "y") == [10, 11]
    assert write_batch({"x": ids(3, 6), "y": ids(12, 14)}, folder, 1)
    assert not write_batch({"x": ids(3, 6), "y": ids(12, 14)}, folder, 1)
    assert write_batch({"x": ids(6, 7)}, folder, 2) and write_batch({"x": ids(0, 0), "y": ids(0, 0)}, folder, 3)
    assert seen(spark, folder, "x") == list(range(7)) and seen(spark, folder, "y") == [10, 11, 12, 13] and seen(spark, folder, "z") == []


def test_a_stream_goes_on_after_a_sink_that_failed(spark, tmp_path):
    for k in range(3):
        spark.range(k * 5, k * 5 + 5).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    good = lambda df: {"x": df, "y": df.select((F.col("id") * 2).alias("id"))}
    bad = lambda df: {"x": df, "y": df.select(F.when(F.col("id") >= 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id") * 2).cast("long").alias("id"))}
    with pytest.raises(Exception, match="lost"):
        jobs.deliver(stream(), bad, str(tmp_path), "d")
    folder = str(tmp_path / "turnlake-delivery-d" / "out")
    assert seen(spark, folder, "x") == list(range(5)) and seen(spark, folder, "y") == list(range(0, 10, 2))
    assert jobs.deliver(stream(), good, str(tmp_path), "d") == folder
    assert seen(spark, folder, "x") == list(range(15)) and seen(spark, folder, "y") == list(range(0, 30, 2))


def test_drift_history_keeps_the_last_good_run(spark, tmp_path):
    from turnlake.operators import profile

    folder = str(tmp_path / "runs")
    a, b, odd = ("new", "path", "k", ".a", "string"), ("breaking", "type", "k", ".b", "number"), ("info", "absent", None, None, None)
    made = [[a, b], [a], None, [a, b, b], [odd], [b], None]
    for i, rows in enumerate(made):
        profile.record_run(None if rows is None else spark.createDataFrame(rows, profile.FINDING), f"r{i}", folder, spark)
    got = {tuple(r)[:5]: tuple(r)[5:] for r in profile.drift_history(*profile.recorded(spark, folder)).collect()}
    assert got == {a: ("r0", "r3", 3, 0, 0, False), b: ("r0", "r5", 3, 2, 1, True), odd: ("r4", "r4", 1, 0, 0, False)}
    nothing = spark.createDataFrame([], "run string, ok boolean")
    assert profile.drift_history(profile.recorded(spark, folder)[0], nothing).count() == 0


@pytest.mark.parametrize("sizes", [[40], [1, 1, 13, 25], [20, 20]])
def test_a_cap_on_a_stream_equals_a_sequential_fold(spark, tmp_path, sizes):
    import random

    rng = random.Random(8)
    values = [rng.choice(["a", "b", "c", "d", "e", "f", "", None]) for _ in range(40)]
    seen, expected = [], []
    for v in values:
        if v and v not in seen and len(seen) < 3:
            seen.append(v)
        expected.append(v if not v or v in seen else "_other")
    start = 0
    for n in sizes:
        rows = [(i, values[i]) for i in range(start, start + n)]
        spark.createDataFrame(rng.sample(rows, n), "i long, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        start += n
    stream = spark.readStream.schema("i long, v string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    rows, report = jobs.cap_stream(stream, "v", ["i"], 3, str(tmp_path))
    assert [r["v"] for r in rows.orderBy("i").collect()] == expected
    assert report.first().asDict() == {"field": "v", "distinct": 3, "rejected": expected.count("_other")}


def test_streams_of_turns_and_logs_join_and_late_logs_correct_them(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    at = lambda m: datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(minutes=m)
    turns = [[("a", at(0)), ("b", at(1)), (None, at(2)), ("c", at(3))], [("d", at(60)), ("e", None)], [("z", at(300))], [("z2", at(600))]]
    logs = [[("a", at(5), 1), ("a", at(6), 2), (None, at(2), 9)], [("d", at(59), 4)], [("b", at(200), 5), ("d", at(290), 6), ("x", at(300), 7)], [("z2", at(600), 8)]]
    put = lambda rows, schema, where: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / where))
    for t, g in zip(turns, logs, strict=True):
        put(t, "k string, ts timestamp", "t")
        put(g, "k string, at timestamp, id long", "l")
    read = lambda schema, where: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / where))
    out = jobs.drain(jobs.attach_stream(read("k string, ts timestamp", "t"), read("k string, at timestamp, id long", "l"), "k", "ts", "at"), str(tmp_path))
    got = sorted((r["k"] or "-", r["log"] and r["log"]["id"]) for r in out.collect())
    assert got == [("-", None), ("a", 1), ("a", 2), ("b", None), ("c", None), ("d", 4), ("z", None), ("z2", 8)]
    everything = spark.createDataFrame([g for part in logs for g in part], "k string, at timestamp, id long")
    assert {(r["k"], r["log"]["id"], r["was"]) for r in jobs.corrections(out, everything, "k", "id").collect()} == {("b", 5, "miss"), ("d", 6, "hit")}
