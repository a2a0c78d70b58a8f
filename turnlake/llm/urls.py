"""URL filter on sorted digest arrays.

The rules become three plain files: the sorted 64-bit xxHash keys, the offsets of their strings, and the strings. Executors get the
files from Spark, map them into memory, and probe a whole batch of URLs with one vectorised binary search per key shape; a hit counts
only when the stored string equals the probed one, so a digest collision cannot change a verdict.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.llm.common import materialize

#: The rules of the registered query, (text, verdict); the text is a host and the start of a path.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Words that block a host when one of its labels' hyphen-separated parts equals them and no rule fits.
HOST_WORDS = ("adult", "casino", "escort", "gambling", "phishing", "pills", "porn", "sex", "spam", "viagra", "warez", "xxx")
#: Rules of more bytes than this stay a table that the probes are joined with: the index is sent whole to every executor.
MAX_INDEX_BYTES = 64 << 20

_SEP = "\x00"
_SUFFIX, _WORD = "r", "w"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: next((i for i, c in enumerate(rest) if c in "?#"), len(rest))]
    return host.translate(_LOWER), path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _digest(keys: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass")) for k in keys), np.uint64)


class DigestArray:
    """Sorted digests with their strings and values, read from three memory-mapped files."""

    def __init__(self, folder: str, name: str) -> None:
        self.keys = np.load(os.path.join(folder, f"{name}.keys.npy"), mmap_mode="r")
        self.offsets = np.load(os.path.join(folder, f"{name}.offsets.npy"), mmap_mode="r")
        self.strings = np.load(os.path.join(folder, f"{name}.strings.npy"), mmap_mode="r")

    @staticmethod
    def write(entries: dict[str, str], folder: str, name: str) -> list[str]:
        texts = list(entries)
        digests = _digest(texts)
        order = np.argsort(digests, kind="stable")
        blobs = [f"{texts[i]}{_SEP}{entries[texts[i]]}".encode("utf-8", "surrogatepass") for i in order]
        files = {
            "keys": digests[order],
            "offsets": np.cumsum([0, *map(len, blobs)], dtype=np.int64),
            "strings": np.frombuffer(b"".join(blobs), np.uint8),
        }
        paths = []
        for part, values in files.items():
            paths.append(os.path.join(folder, f"{name}.{part}.npy"))
            np.save(paths[-1], values)
        return paths

    def get(self, texts: list[str]) -> list[str | None]:
        """The value of each text, or None. Equal digests lie side by side, and each is compared in full."""
        digests = _digest(texts)
        first = np.searchsorted(self.keys, digests)
        out: list[str | None] = [None] * len(texts)
        inside = first < len(self.keys)
        hits = np.flatnonzero(inside)[self.keys[first[inside]] == digests[inside]]
        for i in hits:
            k, wanted = int(first[i]), texts[i].encode("utf-8", "surrogatepass")
            while k < len(self.keys) and self.keys[k] == digests[i]:
                text, _, value = bytes(self.strings[self.offsets[k] : self.offsets[k + 1]]).rpartition(_SEP.encode())
                if text == wanted:
                    out[i] = value.decode()
                    break
                k += 1
        return out


def publish_rules(
    spark: SparkSession, rules: Iterable[tuple[str, str]] = RULES, host_words: Iterable[str] = HOST_WORDS
) -> tuple[str, tuple[int, ...], int]:
    """Write the digest array, hand its files to all executors, and return its name, the distinct lengths of rule paths and the longest rule host's."""
    entries: dict[str, str] = {}
    lengths, longest = set(), 0
    for text, verdict in rules:
        host, slash, path = text.partition("/")
        lengths.add(len(slash + path))
        longest = max(longest, len(host))
        entries[f"{_SUFFIX}{host}{_SEP}{slash}{path}"] = verdict
    entries |= {f"{_WORD}{w}": "block" for w in host_words}
    name = f"rules-{uuid.uuid4().hex}"
    for p in DigestArray.write(entries, tempfile.mkdtemp(prefix="turnlake-rules-"), name):
        spark.sparkContext.addFile(p)
    return name, tuple(sorted(lengths, reverse=True)), longest


def _probes(host: str, path: str, lengths: tuple[int, ...], longest: int) -> Iterator[tuple[str, str]]:
    """What a URL is looked up by, as (host, start of the path): every domain it is in that no rule's host is too short for, with every length
    of path that a rule has. So a host of any length has no more probes than the longest rule host has places."""
    least = max(0, len(host) - longest)
    for s in [*([0] if host and not least else []), *(k for k in range(max(least, 1), len(host) + 1) if host[k - 1] == ".")]:
        for n in lengths:
            if n <= len(path):
                yield host[s:], path[:n]


def _judge(urls: list[str | None], index: DigestArray, lengths: tuple[int, ...], longest: int) -> tuple[list, list, list, list]:
    hosts, paths = map(list, zip(*map(split_url, urls), strict=True)) if urls else ([], [])
    probes, owner, shown = [], [], []
    words, word_owner = [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for domain, start in _probes(host, path, lengths, longest):
            probes.append(f"{_SUFFIX}{domain}{_SEP}{start}")
            shown.append(domain + start)
            owner.append(i)
        for w in re.split("[.-]", host) if host else []:
            words.append(_WORD + w)
            word_owner.append(i)
    rule: list[str | None] = [None] * len(urls)
    verdict: list[str] = ["allow"] * len(urls)
    for i, v in zip(word_owner, index.get(words), strict=True):
        if v:
            verdict[i] = v
    for i, text, v in zip(owner, shown, index.get(probes), strict=True):
        if v and (rule[i] is None or len(text) > len(rule[i])):
            rule[i], verdict[i] = text, v
    return hosts, paths, rule, verdict


def _joined(source: DataFrame, rules: DataFrame, host_words: Iterable[str]) -> DataFrame:
    """The verdicts by a join of every URL's probes with a table of rules: for lists that no executor should hold."""
    rules = rules.select(F.substring_index("rule", "/", 1).alias("domain"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("start"), "rule", "verdict")
    rules = materialize(rules.groupBy("domain", "start").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict")), "rules")
    lengths = tuple(r[0] for r in rules.select(F.length("start")).distinct().collect())  # no more than the longest rule is long
    longest = rules.agg(F.max(F.length("domain"))).first()[0] or 0
    rows = materialize(source.withColumn("at", F.monotonically_increasing_id()), "urls")
    blocked = frozenset(host_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u) for u in batch.column(1).to_pylist()]
            probes = [[{"domain": d, "start": p} for d, p in _probes(h, path, lengths, longest)] for h, path in split]
            own = ["block" if blocked.intersection(re.split("[.-]", h)) else "allow" for h, _ in split]
            columns = [batch.column(2), batch.column(0), *[pa.array([x[i] for x in split], pa.string()) for i in range(2)], pa.array(own, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(probes, pa.list_(pa.struct([("domain", pa.string()), ("start", pa.string())])))], ["at", "id", "host", "path", "own", "probes"])

    kind = source.schema["id"].dataType.simpleString()
    split = materialize(rows.mapInArrow(run, f"at long, id {kind}, host string, path string, own string, probes array<struct<domain: string, start: string>>"), "probes")
    found = split.select("at", F.explode("probes").alias("p")).select("at", "p.*").join(rules, ["domain", "start"])
    best = found.groupBy("at").agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("domain"))).alias("best"))
    return split.join(best, "at", "left").select("id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", "own").alias("verdict"))


def filter_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str]] | DataFrame = RULES,
    host_words: Iterable[str] = HOST_WORDS,
    id_col: str = "page_id",
    url_col: str = "url",
    most_bytes: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """Judge every URL: ``(id, host, path, rule, verdict)``, one row per input row.

    ``rules`` are pairs of a rule and its verdict, or a table of them (``rule, verdict``); a table of more than ``most_bytes`` is joined and not
    indexed, with the same result. The longest rule that fits wins, of equals that of the longer domain; a rule fits its host and all
    subdomains when the path starts with the rule's. Of a rule's several verdicts the last given, or the greater of a table's, counts. Without a
    fitting rule, a host with a blocked word in one of its labels is blocked and every other URL is allowed. Null URLs and URLs without ``://``
    have an empty host and path, no rule, and are allowed. Repeated rows and null ids are kept as they are; other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    source = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"))
    if isinstance(rules, DataFrame):
        rules = rules.where("rule is not null and verdict is not null")
        if (rules.agg(F.sum(F.octet_length("rule") + 32)).first()[0] or 0) > most_bytes:
            return _joined(source, rules, host_words).withColumnRenamed("id", id_col)
        rules = [(r["rule"], r["verdict"]) for r in rules.orderBy("rule", "verdict").collect()]  # at most most_bytes
    name, lengths, longest = publish_rules(spark, rules, host_words)
    kind = source.schema["id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(os.path.dirname(SparkFiles.get(f"{name}.keys.npy")), name)
        for batch in batches:
            host, path, rule, verdict = _judge(batch.column(1).to_pylist(), index, lengths, longest)
            texts = [pa.array(x, pa.string()) for x in (host, path, rule, verdict)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *texts], ["id", "host", "path", "rule", "verdict"])

    return source.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
