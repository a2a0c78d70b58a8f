"""Schema induction over JSON and drift against a baseline."""

from __future__ import annotations

import contextlib
import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.functions import columns as X
from turnlake.sources.tables import checkpointed


def _walk(value, path: str, opaque: frozenset[str], embedded: frozenset[str] = frozenset()) -> Iterator[tuple[str, str, str | None]]:
    if isinstance(value, dict):
        yield path, "object", None
        if path not in opaque:
            for k, v in value.items():
                yield from _walk(v, f"{path}.{k}" if path else k, opaque, embedded)
    elif isinstance(value, list):
        yield path, "array", None
        for v in value:
            yield from _walk(v, f"{path}[]", opaque, embedded)
    elif isinstance(value, bool):
        yield path, "bool", str(value).lower()
    elif value is None:
        yield path, "null", None
    elif isinstance(value, str):
        inner = None
        if path in embedded and value.startswith("{"):
            with contextlib.suppress(ValueError):
                inner = json.loads(value)
        yield path, "string", value if inner is None and len(value) <= 48 else None
        if inner is not None:
            yield from _walk(inner, path + "{}", opaque, embedded)
    else:
        yield path, "number", None


def paths(rows: DataFrame, kind: str, doc: str, opaque: frozenset[str] = frozenset(), embedded: frozenset[str] = frozenset()) -> DataFrame:
    """``(kind, path, json_type, value, n)`` of the values in all JSON documents; opaque paths are not entered, and documents inside the strings at
    ``embedded`` paths are, below ``{}``. The walk recurses over unknown structure, so it runs in Python; each task counts equal rows of a batch
    together, and Spark adds up. Null and broken documents count as undecodable.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            seen: Counter[tuple] = Counter()
            for k, text in zip(df["kind"], df["doc"], strict=True):
                try:
                    seen.update((k, *x) for x in _walk(json.loads(text), "", opaque, embedded))
                except (TypeError, ValueError):
                    seen[k, "", "undecodable", None] += 1
            yield pd.DataFrame([(*x, n) for x, n in seen.items()], columns=["kind", "path", "json_type", "value", "n"])

    return rows.select(F.col(kind).alias("kind"), F.col(doc).alias("doc")).mapInPandas(run, "kind string, path string, json_type string, value string, n long")


def induce(walked: DataFrame, most: int | None = None) -> DataFrame:
    """``kind, path, json_type, n``; with ``most``, of each kind's paths the most frequent ones only, and ``capped``."""
    out = walked.groupBy("kind", "path", "json_type").agg(F.sum("n").alias("n"))
    if most is None:
        return out
    by_path = out.groupBy("kind", "path").agg(F.sum("n").alias("_n"))
    ranked = _first_of(by_path, ["kind"], "path", [F.desc("_n"), F.col("path")], most)
    return out.join(ranked.select("kind", "path", "capped"), ["kind", "path"])


def _first_of(rows: DataFrame, keys: list[str], member: str, order: list[Column], most: int, salts: int = 64) -> DataFrame:
    """The first ``most`` members of each key, and ``capped``: whether there are more. Ranked in parts first, so that a key of many members is
    no single task's."""
    part = rows.withColumn("_s", F.pmod(F.xxhash64(member), F.lit(salts)))
    part = part.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_s").orderBy(*order)))
    cut = part.where(F.col("_r") <= most).withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    size = rows.groupBy(*keys).agg((F.count("*") > most).alias("capped"))
    return cut.where(F.col("_k") <= most).drop("_s", "_r", "_k").join(size, keys)


def value_counts(walked: DataFrame, most: int = 200) -> DataFrame:
    """The most frequent short values of each path, and whether there are more than ``most`` of them."""
    n = walked.where("value is not null").groupBy("kind", "path", "value").agg(F.sum("n").alias("n"))
    return _first_of(n, ["kind", "path"], "value", [F.desc("n"), F.col("value")], most).select("kind", "path", "value", "n", "capped")


def _summaries(walked: DataFrame, counters: int, held: int) -> DataFrame:
    """``(kind, path, value, low, lost, whole)``: what every task knows of a path's values, in at most ``2 * counters`` rows a path.

    A value's count in the task's rows is from ``low`` to ``low + lost``. When a path has more values than that, what the one after the first
    ``counters`` has is taken from each, and those that have nothing left go: so ``lost`` is at most the task's rows over ``counters``. The row
    without a value says how many rows the path had, and whether nothing was taken.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list] = {}  # of a path: its counts, what was taken, its rows

        def told() -> pd.DataFrame:
            rows = []
            for (kind, path), (counts, lost, n) in known.items():
                rows.append((kind, path, None, n, lost, lost == 0))
                rows.extend((kind, path, v, c, lost, lost == 0) for v, c in counts.items())
            known.clear()
            return pd.DataFrame(rows, columns=["kind", "path", "value", "low", "lost", "whole"])

        size = 0
        for df in frames:
            for kind, path, value, n in zip(df["kind"], df["path"], df["value"], df["n"], strict=True):
                entry = known.setdefault((kind, path), [{}, 0, 0])
                counts = entry[0]
                size += value not in counts
                counts[value] = counts.get(value, 0) + n
                entry[2] += n
                if len(counts) > 2 * counters:
                    take = sorted(counts.values(), reverse=True)[counters]
                    entry[0] = {v: c - take for v, c in counts.items() if c > take}
                    entry[1] += take
                    size -= len(counts) - len(entry[0])
            if size > held:  # of many paths: what is known goes on, and the next rows start anew
                yield told()
                size = 0
        yield told()

    rows = walked.where("value is not null").select("kind", "path", "value", "n")
    return rows.mapInPandas(run, "kind string, path string, value string, low long, lost long, whole boolean")


def frequent_values(walked: DataFrame, most: int = 200, counters: int = 2000, held: int = 1_000_000, small: int = 200_000) -> DataFrame:
    """``kind, path, value, n, capped``: :func:`value_counts` without a shuffle of every distinct value.

    A path of at most ``counters`` distinct values gives its first ``most`` by count, then value. Of one with more, which is ``capped`` in any
    case, only values count that have more than one row in ``counters`` of the path's; they are counted exactly too, and the result depends on
    the rows alone, not on how they are spread. So a path of ids gives those that come up often, and none if none does.

    Each task sums a path up in at most ``4 * counters`` values (and goes on anew past ``held`` of them over all paths), and only these sums are
    shuffled. What can be frequent by them, at most about ``2 * counters`` values a path, is counted in a second pass over the rows. It is
    broadcast up to ``small`` values and joined beyond. Null values (long texts and the like) don't count. ``walked`` is read twice.
    """
    if most > counters:
        raise ValueError("counters must not be fewer than the values asked for")
    key = ["kind", "path"]
    sums = checkpointed(_summaries(walked, 2 * counters, held))
    values = sums.where("value is not null").groupBy(*key, "value").agg(F.sum("low").alias("low"))
    paths_ = sums.where("value is null").groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.sum("low").alias("_rows"), F.sum("lost").alias("_lost"), F.bool_and("whole").alias("_whole"))
    same = F.col("kind").eqNullSafe(F.col("_kind")) & (F.col("path") == F.col("_path"))
    distinct = values.groupBy(*key).agg(F.count("*").alias("_distinct"))
    paths_ = distinct.join(paths_, same).select("_kind", "_path", "_rows", "_lost", "_distinct", (F.col("_whole") & (F.col("_distinct") <= counters)).alias("_few"))
    marked = checkpointed(values.join(paths_, same).select(*key, "value", "low", "_rows", "_lost", "_distinct", "_few").where(F.col("_few") | ((F.col("low") + F.col("_lost")) * counters > F.col("_rows"))))
    few = marked.where("_few").select(*key, "value", F.col("low").alias("n"), (F.col("_distinct") > most).alias("capped"))
    asked = marked.where("not _few").select(*[F.col(k).alias(f"_{k}") for k in (*key, "value")], F.col("_rows").alias("_all"))
    asked = F.broadcast(asked) if asked.count() <= small else asked
    again = walked.where("value is not null").join(asked, same & (F.col("value") == F.col("_value"))).groupBy(*key, "value").agg(F.sum("n").alias("n"), F.first("_all").alias("_all"))
    many = again.where(F.col("n") * counters > F.col("_all")).select(*key, "value", "n", F.lit(True).alias("capped"))
    order = Window.partitionBy(*key).orderBy(F.desc("n"), "value")  # at most `counters` rows a path
    return few.unionByName(many).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")


def drift(base: DataFrame, now: DataFrame) -> DataFrame:
    """Findings ``(severity, what, kind, path, json_type)`` between two signatures of :func:`induce`.

    A type that a known path didn't have is breaking (null is new), a path or kind that wasn't there is new, one that is gone is info.
    """
    key = ["kind", "path", "json_type"]
    added, gone = now.select(*key).join(base.select(*key), key, "left_anti"), base.select(*key).join(now.select(*key), key, "left_anti")
    known = base.select("kind", "path").distinct().withColumn("known", F.lit(True))
    a = added.join(known, ["kind", "path"], "left")
    severity = F.when(F.col("known") & (F.col("json_type") != "null"), "breaking").otherwise("new")
    what = F.when(F.col("known") & (F.col("json_type") == "null"), "nullable").when(F.col("known"), "type").otherwise("path")
    return a.select(severity.alias("severity"), what.alias("what"), *key).unionByName(gone.select(F.lit("info").alias("severity"), F.lit("absent").alias("what"), *key))


def severity_counts(findings: DataFrame) -> DataFrame:
    """Always three rows."""
    every = findings.sparkSession.createDataFrame([("breaking",), ("new",), ("info",)], "severity string")
    n = findings.groupBy("severity").count()
    return every.join(n, "severity", "left").select("severity", F.coalesce("count", F.lit(0)).alias("n"))


def head_and_stride(rows: DataFrame, kind: str, order: list[str], head: int, stride: int) -> DataFrame:
    """Sampling operator: the first rows of each kind, then every ``stride``-th.

    Rows are sorted over all tasks, by kind and order, and numbered from how many of a kind the parts before hold: a kind of many rows is spread
    like the others. Ties in the order are broken by the other columns' hash; null kinds are a kind.
    """
    tie = F.xxhash64(*[F.col(c) for c in rows.columns])
    spread = rows.withColumn("_tie", tie).repartitionByRange(kind, *order, "_tie").sortWithinPartitions(kind, *order, "_tie")
    placed = checkpointed(spread.drop("_tie").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    parts = placed.groupBy(F.col(kind).alias("_kind"), "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    w = Window.partitionBy("_kind").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_kind", F.col("_part").alias("_p"), "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    numbered = placed.join(parts, F.col(kind).eqNullSafe(F.col("_kind")) & (F.col("_part") == F.col("_p")))
    r = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return numbered.where((r <= head) | ((r - head) % stride == 0)).select(*rows.columns)


def key_shapes(rows: DataFrame, kind: str, doc: str) -> DataFrame:
    """``kind, shape, n``: the sorted top-level keys of each document as one text."""
    shape = F.array_join(F.array_sort(F.json_object_keys(doc)), ",")
    return rows.groupBy(F.col(kind).alias("kind"), F.coalesce(shape, F.lit("<none>")).alias("shape")).agg(F.count("*").alias("n"))


def file_profile(frames: DataFrame) -> DataFrame:
    """Lines, bad lines and the first and last time of each file."""
    return frames.groupBy("file").agg(F.count("*").alias("lines"), F.count_if(~F.col("decode_ok")).alias("bad"), F.min("ts").alias("first"), F.max("ts").alias("last"))


def safe_enums(counts: DataFrame, most: int = 32, length: int = 48) -> DataFrame:
    """Values of paths that look like enums: few, short, and without digits runs that ids have. From :func:`value_counts`."""
    id_like = F.regexp_like("value", F.lit("[0-9]{4,}|[0-9a-fA-F]{8}-"))
    g = counts.groupBy("kind", "path").agg(F.count("*").alias("_n"), F.max(F.length("value")).alias("_len"), F.max(id_like.cast("int")).alias("_id"), F.array_sort(F.collect_set("value")).alias("values"))
    return g.where((F.col("_n") <= most) & (F.col("_len") <= length) & (F.col("_id") == 0)).select("kind", "path", "values")  # at most 200 values a path


def signature(induced: DataFrame) -> DataFrame:
    """A baseline without content: paths, types and the order of magnitude of their counts."""
    return induced.select("kind", "path", "json_type", (F.length(F.col("n").cast("string")) - 1).alias("magnitude"))


def cross_tab(rows: DataFrame, kind: str, event: str, order: str) -> DataFrame:
    """``kind, event, n, sample``: how often each pair occurs, and the first row of each that shows it."""
    return rows.groupBy(F.col(kind).alias("kind"), F.col(event).alias("event")).agg(F.count("*").alias("n"), F.min(order).alias("sample"))


FINDING = "severity string, what string, kind string, path string, json_type string"


def record_run(findings: DataFrame | None, run: str, folder: str, spark: SparkSession | None = None) -> None:
    """Append a run's findings, and a note that it ran. A run that failed has None (and names its session): it is noted, and has no findings.

    The note comes last, so a run whose findings were written in part is none.
    """
    spark = findings.sparkSession if findings is not None else spark
    if findings is not None:
        findings.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(folder)
    note = spark.range(1).select(F.lit(run).alias("run"), F.lit(findings is not None).alias("ok"))
    note.coalesce(1).write.mode("append").parquet(f"{folder.rstrip('/')}/_runs")


def recorded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(findings, runs)`` as :func:`record_run` has left them: findings with ``run``, and ``(run, ok)``. A run noted twice counts as its better note."""
    runs = spark.read.schema("run string, ok boolean").parquet(f"{folder.rstrip('/')}/_runs").groupBy("run").agg(F.max("ok").alias("ok"))
    return spark.read.schema(f"{FINDING}, run string").parquet(folder), runs


def drift_history(findings: DataFrame, runs: DataFrame) -> DataFrame:
    """Each finding over all runs: ``first_seen, last_seen, runs, flaps, streak, current``. Runs are in the order of their names.

    Only good runs count: one that failed neither ends a streak nor is part of it. ``runs`` is in how many the finding was, ``flaps`` how often it
    came back after a good run without it, ``streak`` in how many in a row up to the last good run (0 if it is gone), and ``current`` whether it
    is in that one: when the newest run failed, the last good one's findings stand. Equal findings of a run are one; nulls are values.
    """
    key = ["severity", "what", "kind", "path", "json_type"]
    good = runs.where("ok").select("run", F.row_number().over(Window.orderBy("run")).alias("n"))  # one row a run
    total = good.agg(F.coalesce(F.max("n"), F.lit(0)).alias("total"))
    w = Window.partitionBy(*key).orderBy("n")
    rows = findings.select(*key, "run").distinct().join(good, "run").withColumn("island", F.col("n") - F.row_number().over(w))
    stays = rows.groupBy(*key, "island").agg(F.min("run").alias("begin"), F.max("run").alias("end"), F.count("*").alias("k"), F.max("n").alias("n"))
    out = stays.groupBy(*key).agg(F.min("begin").alias("first_seen"), F.max("end").alias("last_seen"), F.sum("k").alias("runs"), (F.count("*") - 1).alias("flaps"), F.max(F.struct("n", "k")).alias("last"))
    out = out.crossJoin(F.broadcast(total)).withColumn("current", F.col("last.n") == F.col("total"))  # one row
    return out.select(*key, "first_seen", "last_seen", "runs", "flaps", F.when(F.col("current"), F.col("last.k")).otherwise(0).alias("streak"), "current")


def sampled_windows(rows: DataFrame, file: str, position: str, windows: int, width: int) -> tuple[DataFrame, DataFrame]:
    """Sampling operator: the rows in evenly spaced windows of each file, and ``(file, rows, sampled, coverage)``. A sample proves no absence."""
    size = rows.groupBy(file).agg((F.max(position) + 1).alias("_n"))
    df = rows.join(size, file)
    at, n = F.col(position), F.col("_n")
    start = F.floor(F.floor(at * windows / n) * n / windows)
    df = df.withColumn("_in", at - start < width)
    g = df.groupBy(file).agg(F.count("*").alias("rows"), F.count_if("_in").alias("sampled"))
    return df.where("_in").drop("_n", "_in"), g.withColumn("coverage", F.col("sampled") / F.col("rows"))


#: Fields and headers whose values are counted; of others it counts only that they are there.
FIELDS, HEADERS = ("direction", "kind", "method", "transport"), ("originator", "version", "x-openai-subagent")
#: The paths at which a string holds a document.
EMBEDDED = frozenset({"client_metadata.x-codex-turn-metadata", "item.arguments", "input[].arguments"})


def capture_signature(frames: DataFrame) -> DataFrame:
    """``section, subject, n`` of decoded frames with their raw lines: what a capture is made of, without content.

    Sections: keys of lines, headers, values of known fields and headers (``<set>`` for others), shapes of request ids, framing of payloads and
    key sets of those that are objects, pairs of kind and event, event types, patterns of file names, and ``lines``, with those that don't decode
    and payloads that don't parse. Transport frames have no payload to speak of. Everything is one aggregation over small strings.
    """
    pair = lambda section, subject: F.struct(F.lit(section).alias("section"), subject.alias("subject"))
    many = lambda section, names: F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda x: F.struct(F.lit(section).alias("section"), x.alias("subject")))
    c, spoken = F.col, ~F.col("is_transport")
    shown = lambda name, value, known: F.concat(F.lit(f"{name}="), value) if known else F.lit(f"{name}=<set>")
    values = [F.when(X.present(c(f)).isNotNull(), pair("record.field", shown(f, c(f), f in FIELDS))) for f in ("direction", "kind", "method", "transport", "url", "account_id")]
    values += [F.when(X.present(c("headers")[h]).isNotNull(), pair("record.header_value", shown(h, c("headers")[h], True))) for h in HEADERS]
    one = F.array(
        pair("lines", F.when(c("decode_ok"), "decoded").otherwise("undecodable")), pair("filename", X.digit_mask(c("file"))), F.when(c("decode_ok"), pair("request_id_shape", X.id_shape(c("request_id")))),
        F.when(c("decode_ok") & spoken, pair("payload_framing", X.framing(c("payload_text")))), F.when(c("decode_ok") & spoken & X.present(c("payload_text")).isNotNull() & c("ev_type").isNull(), pair("unparsed", F.lit("payload"))),
        F.when(c("event").isNotNull(), pair("payload_shape", F.array_join(F.array_sort(F.json_object_keys("event")), ","))), F.when(c("ev_type").isNotNull(), pair("event.type", c("ev_type"))),
        F.when(c("ev_type").isNotNull(), pair("kind_event", F.concat_ws(" ", F.coalesce("kind", F.lit("")), "ev_type"))), *values,
    )
    keys = F.when(c("decode_ok"), F.json_object_keys("raw"))
    rows = frames.select(F.explode(F.filter(F.concat(one, many("record.key", keys), many("record.header", F.map_keys("headers"))), lambda x: x.isNotNull())).alias("x"))
    return rows.groupBy("x.section", "x.subject").agg(F.count("*").alias("n"))


#: How grave it is when a section has a subject that the baseline lacks.
ADDED = {
    "payload_framing": "breaking", "payload_shape": "breaking", "filename": "new", "record.key": "new", "record.header": "new", "request_id_shape": "new", "record.field": "new", "record.header_value": "new",
    "kind_event": "new", "event.type": "new",
}


def capture_drift(base: DataFrame, now: DataFrame, share: float = 0.01) -> DataFrame:
    """``severity, kind, subject, was, is`` between two :func:`capture_signature` tables.

    What is added is as grave as its section; keys and event types that are gone, and event types two orders of magnitude rarer, are info; a share
    of undecodable lines or unparsed payloads that grows by more than ``share`` is breaking. Subjects of equal severity go by kind and name.
    """
    b, n = base.select("section", "subject", F.col("n").alias("was")), now.select("section", "subject", F.col("n").alias("is"))
    both = b.join(n, ["section", "subject"], "full")
    grave = F.create_map(*[F.lit(x) for pair in ADDED.items() for x in pair])
    fewer = X.magnitude(F.col("was")) - X.magnitude(F.col("is")) >= 2
    severity = (
        F.when(F.col("was").isNull(), grave[F.col("section")]).when(F.col("is").isNull() & F.col("section").isin("record.key", "event.type"), "info").when(F.col("section").eqNullSafe("event.type") & fewer, "info")
    )
    kind = F.when(F.col("was").isNull(), F.col("section")).when(F.col("is").isNull(), F.concat("section", F.lit(".absent"))).otherwise("event.volume")
    found = both.withColumns({"severity": severity, "kind": kind}).where("severity is not null").select("severity", "kind", "subject", "was", "is")
    bad = F.sum(F.when((F.col("section") == "lines") & (F.col("subject") == "undecodable"), F.col("n")).otherwise(0))
    unparsed, lines = F.sum(F.when(F.col("section") == "unparsed", F.col("n")).otherwise(0)), F.greatest(F.sum(F.when(F.col("section") == "lines", F.col("n")).otherwise(0)), F.lit(1))
    cells = lambda df: df.agg(F.struct((bad / lines).alias("undecodable"), (unparsed / lines).alias("unparsed_payload"), (10_000 * bad / lines).cast("long").alias("b"), (10_000 * unparsed / lines).cast("long").alias("u")).alias("s"))
    pair = cells(base).select(F.col("s").alias("x")).crossJoin(F.broadcast(cells(now).select(F.col("s").alias("y"))))  # one row each
    worse = [F.when(F.col(f"y.{k}") > F.col(f"x.{k}") + share, F.struct(F.lit("breaking").alias("severity"), F.lit(k).alias("kind"), F.lit("per 10,000 lines").alias("subject"), F.col(f"x.{p}").alias("was"), F.col(f"y.{p}").alias("is"))) for k, p in (("undecodable", "b"), ("unparsed_payload", "u"))]
    shares = pair.select(F.explode(F.filter(F.array(*worse), lambda w: w.isNotNull())).alias("w")).select("w.*")
    rank = F.when(F.col("severity") == "breaking", 0).when(F.col("severity") == "new", 1).otherwise(2)
    return found.unionByName(shares).orderBy(rank, "kind", "subject")


def value_drift(base: DataFrame, now: DataFrame) -> DataFrame:
    """Values of enum-like paths that a baseline of :func:`safe_enums` doesn't list, for paths it knows: ``kind, path, value``, all of them new."""
    known = base.select("kind", "path", F.col("values").alias("old"))
    e = now.join(known, ["kind", "path"]).select("kind", "path", F.explode(F.array_except("values", "old")).alias("value"))
    return e.withColumn("severity", F.lit("new"))
