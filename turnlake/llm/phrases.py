"""Phrase collocations from suffixes sorted to a depth of three words.

Every word occurrence is a suffix of its piece. A chunk of texts numbers its words and counts equal suffixes of its own, then routes them by
their leading words: ranges of a key made of digests of the first, second and third word, cut so that each range has about as many suffixes. A
word, or a pair, with a large share of all occurrences so goes on over several ranges, split by the words that follow.

A range's suffixes are pointers that a multikey three-way quicksort partitions: the first words against a pivot's, those equal to it again by
their second words, and these by their third. The size of an equal partition is the count of its phrase. A partition below the least count is
abandoned, as no phrase in it can reach that count; only of phrases that a range's border may cut are parts kept, and added up afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.llm.common import materialize
from turnlake.llm.lm import pack, unpack
from turnlake.llm.mixing import _numbered

#: Suffixes that a chunk counts before it routes them, that a range should have, and for each of which one is looked at to cut the ranges.
CHUNK, RANGE, SAMPLE = 1 << 21, 1 << 21, 1 << 13
#: Ranges that a chunk routes to at once; with more, suffixes are routed in several rounds, bundle by bundle.
FAN = 1 << 10
#: Partitions of so few pointers are sorted outright.
SMALL = 1 << 13
#: Bytes of text whose words are held at once.
_SEGMENT = 1 << 20
#: Bits of a word's number in a chunk, and of each word's digest in the routing key.
_BITS = 21

_BORDERS = b".,;:!?\n\x0b\x0c\r"
#: Lower case for A-Z, one kind of border (a character that no word holds), one kind of space.
_TABLE = bytes(
    46 if c in _BORDERS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)


class _Numbers(dict):
    """Words by number in order of appearance; 0 is a border, or no word."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _windows(data: bytes) -> Iterator[tuple[list[bytes], int]]:
    """Words and borders of a text in bounded lists, with how many of them are the list's own: two more follow where there are any."""
    data, start = data.translate(_TABLE).replace(b".", b" . "), 0
    while start < len(data):
        cut = data.find(b" ", start + _SEGMENT) if len(data) - start > _SEGMENT else len(data)
        cut = len(data) if cut < 0 else cut
        words, ahead, reach = data[start:cut].split(), [], 4096
        while cut < len(data):
            ahead = data[cut : cut + reach].split()
            if len(ahead) > 2 or cut + reach >= len(data):
                break
            reach *= 4
        yield words + ahead[:2], len(words)
        start = cut


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts by language, short ones put together with a border between them."""
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            waiting.setdefault(lang, []).append(text.as_py())
            sizes[lang] = sizes.get(lang, 0) + len(waiting[lang][-1])
            if sizes[lang] >= _SEGMENT:
                yield lang, b".".join(waiting.pop(lang))
                del sizes[lang]
        for lang, found in waiting.items():
            yield lang, b".".join(found)


def _digests(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _keys(lang: str, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Routing keys from the words' digests (0 for none), as non-negative 64-bit integers: 21 bits of each word, the first's with the language's."""
    own, low = np.uint64(xxhash.xxh3_64_intdigest(lang.encode())), np.uint64(64 - _BITS)
    return ((first ^ own) >> low << np.uint64(2 * _BITS) | second >> low << np.uint64(_BITS) | third >> low).astype(np.int64)


def _survey(sample: int):
    """How many words each language has, and the routing keys of one suffix in ``sample``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        keys, skipped = [], 0
        for lang, data in _texts(batches):
            for words, own in _windows(data):
                counts[lang] = counts.get(lang, 0) + own - words[:own].count(b".")
                for at in range(-skipped % sample, own, sample):
                    taken = (words[at : at + 3] + [b"."] * 2)[:3]
                    if taken[0] != b".":
                        d = _digests(taken) * np.array([1, taken[1] != b".", b"." not in taken], np.uint64)
                        keys.append(int(_keys(lang, d[:1], d[1:2], d[2:])[0]))
                skipped += own
        langs = [*counts, *[None] * len(keys)]
        columns = [pa.array(langs, pa.string()), pa.array([*counts.values(), *[None] * len(keys)], pa.int64()), pa.array([*[None] * len(counts), *keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "key"])

    return run


_MESSAGE = "lang string, part long, chunk long, words binary, w1 binary, w2 binary, w3 binary, n binary"


def _cut(lang: str, words: list[bytes], ids: np.ndarray, n: np.ndarray, bounds: np.ndarray, step: int) -> Iterator[dict]:
    """Messages: the suffixes (three rows of word numbers, with counts) of each range, with its own words numbered from 1."""
    digests = _digests(words)
    digests[0] = 0  # no word
    part = np.searchsorted(bounds, _keys(lang, *digests[ids]), "right") // step
    order = np.argsort(part, kind="stable")
    ids, n, part = ids[:, order], n[order], part[order]
    borders = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        used, local = np.unique(np.append(ids[:, a:b], 0), return_inverse=True)
        local = local[:-1].reshape(3, b - a)
        text = b" ".join(words[k] for k in used[1:].tolist())
        columns = [local[0].astype("<u4"), local[1].astype("<u4"), local[2].astype("<u4")]
        columns[0] = np.diff(columns[0], prepend=np.uint32(0))  # rows are sorted by it, or this wraps around
        yield {
            "lang": lang, "part": int(part[a]), "words": len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True),
            "w1": pack(columns[0], "<u4"), "w2": pack(columns[1], "<u4"), "w3": pack(columns[2], "<u4"), "n": pack(n[a:b], "<i8"),
        }


def _opened(df: pd.DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words of several messages under common numbers, their suffixes and counts."""
    numbers, ids, n = _Numbers(), [], []
    for row in df.itertuples():
        text = pa.decompress(row.words[8:], decompressed_size=int.from_bytes(row.words[:8], "little"), codec="zstd", asbytes=True)
        mine = np.array([0, *map(numbers.__getitem__, text.split(b" "))], np.int64)
        ids.append(mine[np.stack([np.cumsum(unpack(row.w1, "<u4"), dtype="<u4"), unpack(row.w2, "<u4"), unpack(row.w3, "<u4")])])
        n.append(unpack(row.n, "<i8"))
    return list(numbers), np.concatenate(ids, axis=1), np.concatenate(n)


def _summed(ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal suffixes once, sorted, with their counts together."""
    order = np.lexsort(ids[::-1])
    ids, n = ids[:, order], n[order]
    new = np.flatnonzero(np.append(True, (np.diff(ids, axis=1) != 0).any(0)))
    return ids[:, new], np.add.reduceat(n, new)


def _route(bounds: np.ndarray, step: int):
    """Chunks of suffixes as messages to ranges, or to runs of ``step`` ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, _Numbers] = {}
        found: dict[str, list[np.ndarray]] = {}
        held = made = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, keys in found.items():
                packed, n = np.unique(np.concatenate(keys), return_counts=True)
                mask = (1 << _BITS) - 1
                ids = np.stack([packed >> (2 * _BITS), packed >> _BITS & mask, packed & mask])
                rows = [row | {"chunk": made} for row in _cut(lang, list(numbers[lang]), ids, n, bounds, step)]
                yield pa.RecordBatch.from_pylist(rows, schema)
            numbers.clear()
            found.clear()

        for lang, data in _texts(batches):
            for words, own in _windows(data):
                mine = numbers.setdefault(lang, _Numbers())
                a = np.zeros(own + 2, np.int64)
                a[: len(words)] = np.fromiter(map(mine.__getitem__, words), np.int64, len(words))
                first, second, third = a[:own], a[1 : own + 1], a[2:]
                keys = first << (2 * _BITS) | second << _BITS | np.where(second > 0, third, 0)
                found.setdefault(lang, []).append(keys[first > 0])
                held += own
                if held >= CHUNK or len(mine) >= 1 << _BITS - 1:
                    yield from flush()
                    held, made = 0, made + 1
        yield from flush()

    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("chunk", pa.int64()), *[(c, pa.binary()) for c in ("words", "w1", "w2", "w3", "n")]])
    return run


def _reroute(bounds: np.ndarray, step: int):
    """A bundle of messages as messages to finer ranges."""

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        words, ids, n = _opened(df)
        return pd.DataFrame([row | {"chunk": int(key[2])} for row in _cut(key[0], words, *_summed(ids, n), bounds, step)])

    return run


def quicksort(ids: np.ndarray, n: np.ndarray, least: int, edges: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Multikey three-way quicksort of suffix pointers: ``(pointers, counts, depth)`` of the phrases of ``depth`` words that reach ``least``.

    ``ids`` has the suffixes' three words (0: none) and ``n`` how often each occurs. A pointer given stands for the phrase at its start.
    ``edges`` tell which suffixes begin with a word, or a pair, of which there may be more elsewhere: their partitions are never abandoned.
    """
    work = [(np.arange(ids.shape[1]), 0)]
    while work:
        at, depth = work.pop()
        edge = edges[depth][at] if depth < 2 else np.zeros(len(at), bool)
        if not len(at) or n[at].sum() < least and not edge.any():
            continue
        if len(at) <= SMALL:
            yield from _sorted(ids, n, least, edges, at, depth)
            continue
        k = ids[depth][at]
        some = k[:: max(1, len(k) // 99)]
        pivot = np.partition(some, len(some) // 2)[len(some) // 2]
        work.append((at[k < pivot], depth))
        work.append((at[k > pivot], depth))
        same = at[k == pivot]
        size = int(n[same].sum())
        if size >= least or edge[k == pivot].any():
            yield same[:1], np.array([size]), depth + 1
            if depth < 2:
                work.append((same[ids[depth + 1][same] > 0], depth + 1))


def _sorted(ids: np.ndarray, n: np.ndarray, least: int, edges: tuple[np.ndarray, np.ndarray], at: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    at = at[np.lexsort([ids[d][at] for d in range(2, depth - 1, -1)])]
    new = np.zeros(len(at), bool)
    new[0] = True
    for d in range(depth, 3):
        k = ids[d][at]
        new[1:] |= k[1:] != k[:-1]
        start = np.flatnonzero(new)
        size = np.add.reduceat(n[at], start)
        kept = size >= least
        if d < 2:
            kept |= edges[d][at[start]]
        kept &= k[start] > 0
        yield at[start[kept]], size[kept], d + 1


def _count(bounds: np.ndarray, least: int):
    """The phrases of a range that reach the least count, and the parts of those that its borders may cut."""

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        lang, part = key
        words, ids, n = _opened(df)
        digests = _digests(words)
        digests[0] = 0
        keys = _keys(lang, *digests[ids])
        border = bounds[max(part - 1, 0) : part + 1]
        edges = tuple(np.isin(keys >> s, border >> s) for s in (2 * _BITS, _BITS))
        phrases, counts, depths = [], [], []
        for at, sizes, depth in quicksort(ids, n, least, edges):
            phrases += [b" ".join(words[k] for k in row).decode() for row in ids[:depth, at].T.tolist()]
            counts.append(sizes)
            depths += [depth] * len(at)
        counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        texts = {"lang": np.full(len(phrases), lang, object), "phrase": np.array(phrases, object)}
        return pd.DataFrame(texts | {"k": np.array(depths, np.int32), "n": counts})

    return run


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, fan: int = FAN, range_suffixes: int = RANGE, sample_every: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, k, n)``: phrases of ``k`` words, 1 to 3, that occur at least ``least`` times; and ``(lang, n)``, all word occurrences.

    ``fan``, ``range_suffixes`` and ``sample_every`` say how suffixes are spread over tasks, and change no result.
    """
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    survey = materialize(texts.mapInArrow(_survey(sample_every), "lang string, words long, key long"), "survey")
    sample = survey.where("key is not null").select("key")
    ranges = max(1, round(sample.count() * sample_every / range_suffixes))
    bounds = np.zeros(0, np.int64)
    if ranges > 1:
        every = max(1, range_suffixes // sample_every)
        ranked = _numbered(sample, [F.col("key")], F.lit(0), "bounds")
        cut = ranked.where((F.col("index") > 0) & (F.col("index") % every == 0)).select("key").distinct()
        bounds = np.array(sorted(r[0] for r in cut.collect()), np.int64)  # 8 bytes for some 10 MB of text
    step = 1
    while len(bounds) // (step * fan):
        step *= fan
    messages = texts.mapInArrow(_route(bounds, step), _MESSAGE)
    while step > 1:
        bundle = F.pmod(F.xxhash64("chunk", F.spark_partition_id()), F.lit(step)).alias("chunk")
        bundles = materialize(messages, "messages").select("lang", "part", bundle, "words", "w1", "w2", "w3", "n")
        step //= fan
        messages = bundles.groupBy("lang", "part", "chunk").applyInPandas(_reroute(bounds, step), _MESSAGE)
    found = messages.groupBy("lang", "part").applyInPandas(_count(bounds, least), "lang string, phrase string, k int, n long")
    found = found.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return found, survey.where("words is not null").groupBy("lang").agg(F.sum("words").alias("n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """Millionths of ``a * a / (left * right)``, rounded down, in decimals."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(a) * wide(a)).cast("decimal(38,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, cover: int = 50, top: int = 2000) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words: ``(lang, rank, phrase, a, l, r, n, score)``.

    Texts are put in lower case (A-Z), split at ``.,;:!?`` and line ends, and into words at spaces and tabs. A phrase that occurs ``a >= least``
    times is scored at each of its cuts, ``floor(10**6 * a * a / (l * r))`` from the counts of its two parts, and its lowest score counts, of
    equal ones that of the first cut. A phrase inside a longer one that has ``cover`` percent of its occurrences is dropped. Order: score, then
    ``a``, both descending, then the phrase's bytes. Counts are exact up to 16 digits.

    Null texts are empty, a null language is ``und``; repeated rows count again; texts of any length are read whole; other columns are
    ignored, whatever their names. An empty table, or one without phrases, gives an empty result.
    """
    found, totals = counts(docs, text_col, lang_col, least)
    found = materialize(found, "phrases")
    words = F.split("phrase", " ")
    part = lambda a, n: F.array_join(F.slice(words, a, n), " ")
    cut = lambda k, a, b: F.struct(F.lit(k).alias("cut"), a.alias("left"), b.alias("right"))
    cuts = F.when(F.col("k") == 2, F.array(cut(1, part(1, 1), part(2, 1)))).otherwise(F.array(cut(1, part(1, 1), part(2, 2)), cut(2, part(1, 2), part(3, 1))))
    known = found.select("lang", "phrase", "n")
    cuts = found.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(cuts).alias("c")).select("lang", "phrase", "k", "a", "c.*")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    best = F.min(F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase", "k", "a").agg(best).select("lang", "phrase", "k", "a", "best.l", "best.r", "best.score")
    longer = found.where("k = 3").select("lang", F.explode(F.array(part(1, 2), part(2, 2))).alias("phrase"), "n")
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("longest"))
    alone = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < cover * F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    first = alone.withColumn("rank", rank).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
