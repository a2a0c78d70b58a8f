"""The index of ids: what it opens, that it misses nothing, and that it grows."""

from __future__ import annotations

import json
import os
import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from turnlake.sources import frames as wire
from turnlake.sources import index


def archive_rows(files=32, requests=12):
    rng = random.Random(9)
    for k in range(files):
        for r in range(requests):
            rid = f"ws_{k}_{r}" if r else f"ws_shared-{k // 2}"  # a request that goes on in the next file
            for event in ({"type": "response.create", "input": f"see\nresp_{k}x{r} and C:\\new_{k}z{r}\t\u00e9ab{k}q{r}"}, {"type": "response.completed", "response": {"id": f"resp_{k}_{r}"}}, {"n": rng.randrange(10**9)}):
                yield k, json.dumps({"request_id": rid, "account_id": f"acct-{k % 3}", "headers": {"thread-id": f"conv-{k}.{r}"}, "payload": {"text": json.dumps(event)}})


@pytest.fixture
def corpus(spark, tmp_path):
    lines = spark.createDataFrame(list(archive_rows()), "k int, raw string")
    for k in range(32):
        lines.where(F.col("k") == k).select("raw").coalesce(1).write.option("compression", "gzip").text(str(tmp_path / f"a/{k:02d}"))
    return str(tmp_path / "a"), str(tmp_path / "index")


NAMES = "*.txt.gz"


def test_a_lookup_opens_the_archives_with_the_id_only(spark, corpus, tmp_path):
    archives, folder = corpus
    assert index.update(spark, archives, folder, NAMES) == 32 and index.update(spark, archives, folder, NAMES) == 0
    for k in range(32):
        if k != 7:  # whoever opens another archive fails
            shutil.rmtree(f"{archives}/{k:02d}")
    got = index.lookup(spark, archives, folder, "resp_7_3", NAMES).collect()
    assert {r["request_id"] for r in got} == {"ws_7_3"} and len(got) == 3
    files = {r[0] for r in index.candidates(index.read(spark, folder), ["resp_7_3"]).select("file").collect()}
    assert len(files) == 1 and "/a/07/" in next(iter(files))


def test_lookups_equal_scans_of_everything(spark, corpus, monkeypatch):
    archives, folder = corpus
    index.update(spark, archives, folder, NAMES)
    lines = wire.read_archives(spark, archives, NAMES).cache()
    everywhere = {r[0] for r in index.read(spark, folder).select("file").distinct().collect()}
    ids = ("resp_7_3", "resp_7_", "resp_31x4", "éab5q1", "conv-9.1", "acct-1", "ws_shared-4", "absent-1")
    for literals, files, some in ((16, 10_000, ids), (0, 0, ("ws_shared-4", "completed"))):
        monkeypatch.setattr(index, "MOST_LITERALS", literals)
        monkeypatch.setattr(index, "MOST_FILES", files)
        for wanted in some:
            scan = wire.lookup(lines, index.holds(F.col("raw"), wanted))
            columns = ["request_id", "account_id", "payload_text"]
            got = index.lookup(spark, archives, folder, wanted, NAMES)
            assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, scan.select(columns).collect())), wanted
        assert {r[0] for r in index.candidates(index.read(spark, folder), ["completed"]).select("file").collect()} == everywhere


def test_no_id_of_a_line_is_missed_and_few_strangers_pass(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcXYZ019_-") for _ in range(rng.randrange(1, 24)))
    rows = [(f"f{i % 5}", " ".join(rng.choice([word(), "\\n" + word(), "\\u00e9" + word(), '\\"' + word() + '\\"', "\\\\" + word()]) for _ in range(200))) for i in range(60)] + [("empty", ""), ("null", None)]
    table = index.build(spark.createDataFrame(rows, "file string, raw string")).cache()
    assert {r["file"] for r in table.select("file").collect()} == {"f0", "f1", "f2", "f3", "f4", "empty", "null"}
    held = {(t, f) for f, raw in rows for t in re.findall("[A-Za-z0-9_-]*[0-9][A-Za-z0-9_-]*", re.sub(r"\\(?:[nrtbf]|u[0-9a-f]{4})", " ", raw or ""))}
    ids = spark.createDataFrame([(t,) for t in {t for t, _ in held}], "id string")
    got = {tuple(r) for r in index.candidates(table, ids).collect()}
    assert held <= got and len(got - held) < 0.02 * 5 * ids.count()
    few = sorted({t for t, _ in held})[:14] + ["no digit", "a.b1.c2"]
    assert {tuple(r) for r in index.candidates(table, few).collect()} == {tuple(r) for r in index.candidates(table, spark.createDataFrame([(t,) for t in few], "id string")).collect()}


def test_new_archives_are_added(spark, corpus):
    archives, folder = corpus
    os.makedirs(f"{archives}-later")
    shutil.move(f"{archives}/05", f"{archives}-later/05")
    assert index.update(spark, archives, folder, NAMES) == 31 and index.lookup(spark, archives, folder, "resp_5_2", NAMES).count() == 0
    shutil.move(f"{archives}-later/05", f"{archives}/05")
    assert index.update(spark, archives, folder, NAMES) == 1 and index.lookup(spark, archives, folder, "resp_5_2", NAMES).count() == 3
