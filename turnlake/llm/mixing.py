"""Mixing sources to target weights with a low-discrepancy schedule.

Slot ``i`` of the mix gets the point ``frac(i * golden ratio)``, in 64-bit integers; the sources' cumulative shares cut the unit interval, and the piece the
point falls in names the slot's source. Golden-ratio points fill every piece evenly, so each prefix of the schedule is close to the
targets, not only the whole. Every source's documents, in a seeded shuffle, form one stream that is cut into blocks of equal words; the
slots of a source are ranked, and the slot of rank ``r`` takes block ``r``. A stream that runs out starts again, at most as often as its
target allows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.llm.common import discard, materialize, word_count

#: The golden ratio's fraction of the unit interval, which is the 64-bit integers: multiples wrap round without losing a bit.
GOLDEN = 0x9E3779B97F4A7C15
#: Slots that one row of the schedule's input stands for, and documents for which a source gets another bucket of its shuffle.
_CHUNK, _BUCKET_DOCS = 1 << 15, 1_000
#: Slots that a stretch of the unit interval gets on average: it is a task's share of the schedule.
_STRETCH_SLOTS = 1 << 16
_TOP = 1 << 63
#: Parts of a word in which targets are added up along the unit interval: whole numbers leave no gap between neighbours.
_FINE = 1 << 10


def _numbered(rows: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """The rows, few columns each, with ``index``, their place in the order, and ``before``, the sum of ``value`` over those ahead of them.

    They are sorted over all tasks; only the number of rows and the sum of each task's part are put in one row after the other.
    """
    placed = rows.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id(), "_value": value.cast("long")})
    placed = materialize(placed, name)
    parts = placed.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"), F.sum("_value").alias("_sum"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task's part
    zero = lambda c: F.coalesce(c, F.lit(0))
    parts = parts.select("_part", "_first", zero(F.sum("_n").over(w)).cast("long").alias("_ahead"), zero(F.sum("_sum").over(w)).cast("long").alias("_more"))
    inside = Window.partitionBy("_part", F.shiftright(F.col("_at") - F.col("_first"), 12)).orderBy("_at")
    rows = placed.join(F.broadcast(parts), "_part")  # as many rows as the sort has tasks
    rows = rows.withColumn("_block", F.shiftright(F.col("_at") - F.col("_first"), 12))
    blocks = rows.groupBy("_part", "_block").agg(F.sum("_value").alias("_s"))
    ahead = blocks.select("_part", "_block", zero(F.sum("_s").over(Window.partitionBy("_part").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))).alias("_blocks"))
    rows = rows.join(ahead, ["_part", "_block"])
    own = zero(F.sum("_value").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    out = rows.withColumns({"index": F.col("_at") - F.col("_first") + F.col("_ahead"), "before": F.col("_more") + F.col("_blocks") + own})
    return out.drop("_part", "_at", "_value", "_first", "_ahead", "_more", "_block", "_blocks")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """``sources`` (``index, size``) with ``target``: ``share`` of all sizes split by weight, repeating in order of index; what exceeds ``cap`` times a
    source's size is shared out anew, until none does. Each round is one sum over the sources, and caps more of them or is the last."""
    by_index = F.array(*[F.lit(float(w)) for w in weights])
    rows = sources.withColumn("weight", F.get(by_index, F.pmod("index", F.lit(len(weights))).cast("int")))
    full, budget, level, known = F.col("size") * float(cap), None, None, -1
    while True:
        at = F.lit(False) if level is None else F.lit(level[0]) * F.col("weight") / F.lit(level[1]) > full
        r = rows.agg(F.sum("size"), F.sum(F.when(at, full).otherwise(0.0)), F.sum(F.when(at, 0.0).otherwise(F.col("weight"))), F.count_if(at)).first()
        budget = share * (r[0] or 0)
        if r[3] == known or not r[2]:
            break
        level, known = (budget - r[1], r[2]), r[3]
    if level is None:
        return rows.withColumn("target", F.lit(0.0)).drop("weight")
    own = F.lit(level[0]) * F.col("weight") / F.lit(level[1])
    return rows.withColumn("target", F.when(own > full, full).otherwise(own)).drop("weight")


def _schedule(sources: DataFrame, total: int, slots: int) -> DataFrame:
    """``(slot, src, rank)``: the source of every slot and how many earlier slots that source has. ``sources``: ``src, low, high``, whole numbers
    up to ``total``.

    Slots and the borders of sources meet sorted along the unit interval, in stretches of it; every stretch begins with the source that holds
    its beginning, so a task walks its stretches and never looks back. A source's slots are then ranked by what chunks of them hold.
    """
    spark = sources.sparkSession
    bits = max(4, (slots // _STRETCH_SLOTS).bit_length())

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                slot = np.arange(chunk * _CHUNK, min(slots, (chunk + 1) * _CHUNK), dtype=np.int64)
                x = slot.astype(np.uint64) * np.uint64(GOLDEN)
                columns = [(x >> np.uint64(64 - bits)).astype(np.int64), (x ^ np.uint64(_TOP)).view(np.int64), np.ones(len(slot), np.int8), slot]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["stretch", "x", "what", "ref"])

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each source's border, and the beginnings of stretches that it holds."""
        for batch in batches:
            stretch, x, ref = [], [], []
            for src, low, high in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                begun, ended = (-(-(b << bits) // total) for b in (low, high))
                for at in ((low << 64) // total, *(k << (64 - bits) for k in range(begun, ended))):
                    stretch.append(at >> (64 - bits))
                    x.append(at - _TOP)
                    ref.append(src)
            yield pa.RecordBatch.from_arrays([pa.array(stretch, pa.int64()), pa.array(x, pa.int64()), pa.array([0] * len(x), pa.int8()), pa.array(ref, pa.int64())], ["stretch", "x", "what", "ref"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        src = -1
        for batch in batches:
            what, ref = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            if not len(ref):
                continue
            held = np.maximum.accumulate(np.where(what == 0, np.arange(len(ref)), -1))
            own = np.where(held >= 0, ref[np.maximum(held, 0)], src)
            src = int(own[-1])
            yield pa.RecordBatch.from_arrays([pa.array(ref[what == 1]), pa.array(own[what == 1])], ["slot", "src"])

    shape = "stretch long, x long, what byte, ref long"
    rows = spark.range(-(-slots // _CHUNK)).mapInArrow(points, shape).union(sources.where("high > low").select("src", "low", "high").mapInArrow(borders, shape))
    # of borders at one point the last source's holds, so it comes last
    rows = rows.repartition("stretch").sortWithinPartitions("stretch", "x", "what", "ref").select("x", "what", "ref")
    made = materialize(rows.mapInArrow(walk, "slot long, src long").withColumn("chunk", F.shiftright("slot", _CHUNK.bit_length() - 1)), "slots")
    counts = made.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    w = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("src", "chunk", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    # The plan takes the slots to be as few as the chunks they come from, and would broadcast them.
    return made.withColumn("within", within).join(before.hint("merge"), ["src", "chunk"]).select("slot", "src", (F.col("before") + F.col("within")).alias("rank"))


class Mix:
    """A mix in the making: ``placed`` has a row for each document, ``pieces`` a row for each run of words that a slot takes."""

    def __init__(self, placed: DataFrame, pieces: DataFrame) -> None:
        self.placed, self.pieces = placed, pieces

    def taken(self) -> DataFrame:
        """``placed`` with ``taken``, the words the mix takes of each document."""
        got = self.pieces.groupBy("src", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
        full = self.placed.where("size > 0").join(got, ["src", "start"], "left")
        none = self.placed.where("size = 0").withColumn("taken", F.lit(None).cast("long"))
        return full.unionByName(none).withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 64,
    seed: int = 0,
    carry: tuple[str, ...] = (),
) -> Mix:
    """Plan the mix of all documents; the result is a :class:`Mix` of two tables.

    ``placed``: ``id, source, size, source_size, target, src, start`` and the carried columns; ``start`` is where the document begins in
    its source's stream, so ``(src, start)`` names a document that has words. ``pieces``: ``slot, src, start, epoch, from, to``: slot
    number ``slot`` takes the document's words ``from`` to ``to``. Sources rank by code point, null last. Null texts have size 0; such
    documents are placed and never taken. Rows with equal ids are told apart by their place; ties in the shuffle break by id, size, text and
    the carried columns, so reruns agree. Other columns are ignored. Without words there are no slots, and all targets are 0.
    """
    spark = docs.sparkSession
    base = docs.select(
        docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), word_count(docs[text_col].cast("string")).alias("size"),
        F.xxhash64(docs[text_col].cast("string")).alias("tie"), *[docs[c].alias(f"carry_{c}") for c in carry],
    )
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    sized = materialize(base.withColumn("key", key), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    ranked = _numbered(totals, [F.col("source").isNull(), F.col("source")], F.lit(0), "sources").drop("before")
    aimed = materialize(targets(ranked, weights, share, cap), "targets")
    fine = F.round(F.col("target") * _FINE).cast("long")
    wanted, parts = aimed.agg(F.sum("target"), F.sum(fine)).first()
    slots = round((wanted or 0.0) / block_words)
    cut = _numbered(aimed.select("index", "source", "size", "n", "target").withColumnRenamed("index", "src"), [F.col("src")], fine, "shares").drop("index")
    if slots:
        shares = cut.select("src", F.col("before").alias("low"), (F.col("before") + fine).alias("high"))
        schedule = materialize(_schedule(shares, parts, slots), "schedule")
    else:
        schedule = spark.createDataFrame([], "slot long, src long, rank long")
    counts = schedule.groupBy("src").count()
    words = F.least(F.coalesce(F.col("count"), F.lit(0)) * block_words, (F.col("size") * float(cap)).cast("long"))
    known = cut.join(counts, "src", "left").select("src", F.col("source").alias("name"), F.col("size").alias("source_size"), "target", words.alias("words"), F.greatest(F.lit(1), F.expr(f"n div {_BUCKET_DOCS}")).alias("buckets"))
    targeted = materialize(known, "known")
    placed = sized.join(targeted, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    placed = placed.withColumn("bucket", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("buckets")))
    sums = placed.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
    w = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("src", "bucket", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    inside = Window.partitionBy("src", "bucket").orderBy("key", "id", "size", "tie", *[f"carry_{c}" for c in carry]).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.join(before, ["src", "bucket"]).withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = materialize(placed.drop("key", "tie", "bucket", "buckets", "before"), "placed")
    for done in (sized, aimed, targeted):
        discard(done)
    runs = placed.where("size > 0").select(
        "src", "start", "size", "source_size", "words", F.explode(F.sequence(F.lit(0), F.lit(math.ceil(cap) - 1))).alias("epoch")
    )
    runs = runs.withColumn("at", F.col("epoch") * F.col("source_size") + F.col("start"))
    runs = runs.withColumn("end", F.least(F.col("at") + F.col("size"), "words")).where("at < end")
    b = F.lit(block_words)
    blocks = runs.select("*", F.explode(F.sequence(F.floor(F.col("at") / b), F.floor((F.col("end") - 1) / b))).alias("rank"))
    pieces = blocks.select(
        "src", "start", "epoch", "rank",
        (F.greatest("at", F.col("rank") * b) - F.col("at")).alias("from"),
        (F.least("end", (F.col("rank") + 1) * b) - F.col("at")).alias("to"),
    )
    # The schedule compresses so well that its files look small enough to broadcast; it grows with the words.
    pieces = pieces.join(schedule.hint("merge"), ["src", "rank"]).select("slot", "src", "start", "epoch", "from", "to")
    return Mix(placed, pieces)
