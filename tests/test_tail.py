"""Archives that grow, read as a stream and in batch."""

from __future__ import annotations

import gzip

import pytest

from turnlake.sources import tail
from turnlake.streaming import jobs


def rows(df):
    return sorted((r["file"], r["frame_seq"], r["raw"]) for r in df.collect())


def lines(a, b):
    return "".join(f'{{"n": {i}, "x": "ü{"y" * (i % 50)}"}}\n' for i in range(a, b)).encode()


def drained(spark, folder, tmp_path, name="t", names="*.jsonl.gz"):
    return jobs.drain(tail.stream(spark, str(folder), names), str(tmp_path), name=name)


def test_files_that_grow_are_read_on(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "day").mkdir(parents=True)
    a, b = folder / "2024-01-01T00.jsonl.gz", folder / "day" / "2024-01-01T01.jsonl.gz"
    whole = gzip.compress(lines(0, 400))
    a.write_bytes(whole[: len(whole) // 2])  # a member that isn't complete
    b.write_bytes(gzip.compress(lines(0, 3)) + gzip.compress(b"cut in the mid"))
    first = rows(drained(spark, folder, tmp_path))
    assert first == rows(tail.read(spark, str(folder))) and 3 < len(first) < 403
    cut = {r["file"]: tuple(r)[1:] for r in tail.tails(spark, str(folder)).collect()}
    assert cut["day/2024-01-01T01.jsonl.gz"] == (3, 14, False) and cut["2024-01-01T00.jsonl.gz"][0] == len(first) - 3
    a.write_bytes(whole + gzip.compress(lines(400, 500)))
    with b.open("ab") as f:
        f.write(gzip.compress(b"dle\r\n\n" + lines(5, 6)))
    (folder / "2023-12-31T23.jsonl.gz").write_bytes(gzip.compress(lines(0, 2)))  # a file that comes late and sorts first
    (folder / "other.txt").write_bytes(b"no archive\n")
    expected = [("2023-12-31T23.jsonl.gz", i, x) for i, x in enumerate(lines(0, 2).decode().splitlines())]
    expected += [("2024-01-01T00.jsonl.gz", i, x) for i, x in enumerate(lines(0, 500).decode().splitlines())]
    expected += [("day/2024-01-01T01.jsonl.gz", i, x) for i, x in enumerate([*lines(0, 3).decode().splitlines(), "cut in the middle", "", lines(5, 6).decode().strip()])]
    assert rows(drained(spark, folder, tmp_path)) == expected == rows(tail.read(spark, str(folder)))
    assert rows(drained(spark, folder, tmp_path)) == expected  # nothing new


def test_plain_files_and_every_cut(spark, tmp_path):
    folder, text = tmp_path / "in", lines(0, 12)
    folder.mkdir()
    packed = gzip.compress(text[:150]) + gzip.compress(text[150:])
    for n in (0, 1, 149, 150, 151, len(text) - 1, len(text)):
        (folder / "a.jsonl").write_bytes(text[:n])
        (folder / "b.jsonl").write_bytes(packed[: len(packed) * n // len(text)])
        (folder / "c.jsonl.gz").write_bytes(packed[: len(packed) * n // len(text)])
        got = rows(drained(spark, folder, tmp_path, "p", "[ac].jsonl*"))
        assert [r[2] for r in got if r[0] == "a.jsonl"] == text[:n].decode("utf-8", "ignore").split("\n")[:-1]
    assert [(r[1], r[2]) for r in got if r[0] == "c.jsonl.gz"] == list(enumerate(text.decode().splitlines()))


def test_damage_is_told_and_shrinking_stops(spark, tmp_path):
    folder = tmp_path / "in"
    assert rows(tail.read(spark, str(folder))) == [] and tail.tails(spark, str(folder)).count() == 0  # no folder
    folder.mkdir()
    assert rows(drained(spark, folder, tmp_path)) == []
    good = gzip.compress(lines(0, 4))
    (folder / "a.jsonl.gz").write_bytes(good + b"no member" + good)
    (folder / "e.jsonl.gz").write_bytes(b"")
    assert [r[1] for r in rows(drained(spark, folder, tmp_path))] == [0, 1, 2, 3]
    assert sorted(tuple(r) for r in tail.tails(spark, str(folder)).collect()) == [("a.jsonl.gz", 4, 0, True), ("e.jsonl.gz", 0, 0, False)]
    (folder / "a.jsonl.gz").write_bytes(good[:5])
    with pytest.raises(Exception, match="archives only grow"):
        drained(spark, folder, tmp_path)


def test_large_lines_stay_whole(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    long = b"z" * 9_000_000
    (folder / "a.jsonl.gz").write_bytes(gzip.compress(long + b"\n" + long[:5]))
    (folder / "b.jsonl.gz").write_bytes(gzip.compress(b"\n" * 70_000))
    assert [len(r[2]) for r in rows(tail.read(spark, str(folder), "a*"))] == [9_000_000]
    assert {tuple(r) for r in tail.tails(spark, str(folder)).collect()} == {("a.jsonl.gz", 1, 5, False), ("b.jsonl.gz", 70_000, 0, False)}
