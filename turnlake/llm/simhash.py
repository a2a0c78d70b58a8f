"""SimHash near-duplicates by multi-index hashing.

Equal fingerprints are one class. A pair of classes within the radius differs in at most ``radius // 2`` bits in one half of the
fingerprint, so each half has a table from its 32 bits to the classes that hold them, and every class looks up the Hamming ball around its
own two halves. Flipping only zero bits is enough: of two halves that differ in one bit, one has a zero there. What the tables return is
verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from turnlake.llm.arrow import text_slices, texts
from turnlake.llm.common import discard, materialize
from turnlake.llm.components import connected_components

SEED = 42
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 18
#: Fingerprints of a table's bucket that one task compares at once, on either side; a crowded bucket is split into blocks of these.
BLOCK_ROWS = 1 << 14


def fingerprint(text: str, width: int = 3) -> int:
    """64 bits, each set when over half of the shingles' hashes have it set; zero without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    stops = ends[width - 1 :].tolist()
    for at in range(0, len(starts), _CHUNK):
        h = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)]
        counts += np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the fingerprint as a signed long. Null texts count as empty: fingerprint zero."""
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            found = np.array([fingerprint(t, width) for t in texts(batch, 1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "fp"])

    return source.mapInArrow(run, f"id {kind}, fp long")


def _balls(radius: int) -> list[int]:
    """The masks of at most ``radius`` of 32 bits."""
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(32), n)]


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the pairs connect, at most one for each node: to the least node of its part."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for at in (x, y, root[x], root[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            away = root != np.arange(len(nodes))
            return nodes[away], nodes[root[away]]
        root = new


def _look_up(radius: int):
    """For partitions sorted by bucket, stored rows first: verify each probe against its bucket and keep a forest of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, np.ndarray]] = []
        bucket, held = None, np.zeros(0, np.uint64)  # the stored rows of the bucket that the last batch ended in
        waiting = 0

        def forest() -> pa.RecordBatch:
            a, b = _spanning(*map(np.concatenate, zip(*found, strict=True)))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key, part = batch.column(0).to_numpy() * 2 ** 32 + batch.column(1).to_numpy(), batch.column(2).to_numpy()
            probe, fp = batch.column(3).to_numpy().astype(bool), batch.column(4).to_numpy().view(np.uint64)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(key) | np.diff(part)) + 1, [len(key)]))
            # buckets of one row link nothing, save where a batch may have cut them
            runs = np.unique(np.concatenate(([0], np.flatnonzero(np.diff(edges) > 1), [len(edges) - 2])))
            for lo, hi in zip(edges[runs].tolist(), edges[runs + 1].tolist(), strict=True):
                name = int(key[lo]), int(part[lo])
                mid = lo + int(np.searchsorted(probe[lo:hi], True))
                held = np.concatenate([held, fp[lo:mid]]) if bucket == name else fp[lo:mid]
                bucket = name
                for at in range(mid, hi if len(held) else mid, 256):
                    block = fp[at : min(at + 256, hi)]
                    for start in range(0, len(held), 1 << 16):
                        stored = held[start : start + (1 << 16)]
                        i, j = np.nonzero((np.bitwise_count(block[:, None] ^ stored) <= radius) & (block[:, None] != stored))
                        if len(i):
                            found.append((block[i], stored[j]))
                            waiting += len(i)
                    if waiting > 1 << 20:
                        a, b = _spanning(*map(np.concatenate, zip(*found, strict=True)))
                        found[:] = [(a, b)]
                        waiting = len(a)
                        if waiting > 1 << 19:
                            yield forest()
                            found.clear()
                            waiting = 0
        if found:
            yield forest()

    return run


def _around(radius: int) -> Column:
    """The buckets that a row of bucket ``bits`` looks up: those whose bits it gets by setting at most ``radius`` zero bits."""
    ball = F.array(*[F.lit(m).cast("long") for m in _balls(radius)])
    return F.transform(F.filter(ball, lambda m: F.col("bits").bitwiseAND(m) == 0), lambda m: F.col("bits").bitwiseOR(m))


def links(classes: DataFrame, radius: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints (column ``fp``, distinct) that connect all pairs at most ``radius`` bits apart.

    Each table's bucket is read in one sweep, and what a sweep verifies leaves it as a forest, so a crowd around one text comes out as one
    edge for each of its fingerprints and not as all its pairs. Buckets that store, or are looked up from buckets that store, more than
    ``block_rows`` are split into blocks on both sides; every probe still meets every stored row, once. A radius above 3 is refused: halves
    that differ by one bit set on each side would need probes that flip bits both ways.
    """
    if not 0 <= radius <= 3:
        raise ValueError(f"radius {radius}: links are exact from 0 to 3 bits only")
    words = [F.shiftrightunsigned("fp", 32 * i).bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(2)]
    halves = F.array(*[F.struct(F.lit(i).cast("long").alias("half"), w.alias("bits")) for i, w in enumerate(words)])
    split = classes.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.bits")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    crowded = split.groupBy("half", "bits").agg(F.count("*").alias("s")).where(F.col("s") > block_rows)
    asked = crowded.select("half", F.explode(_around(radius // 2)).alias("bits"), "s").groupBy("half", "bits").agg(F.sum("s").alias("q"))
    crowded = materialize(asked.join(crowded, ["half", "bits"], "left"), "crowded")  # a bucket looks itself up, so all crowded ones are asked
    probe = split.select("half", F.explode(_around(radius // 2)).alias("bits"), one.alias("probe"), "fp")
    rows = split.select("half", "bits", zero.alias("probe"), "fp").union(probe)
    if crowded.isEmpty():
        rows = rows.select("half", "bits", zero.alias("part"), "probe", "fp")
    else:
        blocks = {c: F.coalesce(F.ceil(F.col(c) / block_rows), one).cast("long") for c in ("s", "q")}
        rows = rows.join(crowded, ["half", "bits"], "left").withColumns(blocks)
        side = lambda c, mine: F.when(F.col("probe") == mine, F.array(F.pmod(F.xxhash64("fp"), F.col(c)))).otherwise(F.sequence(zero, F.col(c) - 1))
        rows = rows.withColumn("s_block", F.explode(side("s", 0))).withColumn("q_block", F.explode(side("q", 1)))
        rows = rows.select("half", "bits", (F.col("s_block") * F.col("q") + F.col("q_block")).alias("part"), "probe", "fp")
    rows = rows.repartition("half", "bits", "part").sortWithinPartitions("half", "bits", "part", "probe")
    return rows.mapInArrow(_look_up(radius), "a long, b long")


def _members(classes: DataFrame, radius: int) -> DataFrame:
    """``(fp, component)`` of every class."""
    parts = connected_components(links(classes.select("fp"), radius))
    return classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3
) -> DataFrame:
    """One row per document: ``(id, fingerprint, component_id)``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` is the least id reachable over links, the document's own included.
    Documents of one fingerprint are linked, those without words among them. Null ids count as no id: a component of such rows alone
    has a null ``component_id``. Repeated rows stay; other columns are ignored; an empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, width), "prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    member = _members(classes, radius)
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    mapping = materialize(member.join(least, "component").select("fp", "component_id"), "members")
    discard(classes)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(mapping, "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group of near-duplicates, with its own columns: the one with the least id, null last.

    Rows are told apart by where they are, not by their ids: of several with that id, the one whose columns have the least hash stays. Rows
    without an id, with repeated ids or with equal columns are grouped by their texts like any others; texts that are null or have no words
    form one group. Columns of any name are allowed; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"), F.monotonically_increasing_id().alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            found = np.array([fingerprint(t, width) for t in texts(batch, 1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found)], ["row", "at", "fp"])

    rows = materialize(rows.mapInArrow(run, StructType([rows.schema["row"], StructField("at", LongType()), StructField("fp", LongType())])), "rows")
    name = F.col("row").getField(id_col)
    rank = F.struct(name.isNull().alias("none"), name.alias("id"), F.xxhash64("row").alias("hash"), F.col("at"))
    best = materialize(rows.groupBy("fp").agg(F.min(rank).alias("best")), "classes")
    stay = _members(best, radius).groupBy("component").agg(F.min("best").alias("best")).select("best.at")
    return rows.join(stay, "at", "left_semi").select("row.*")
