"""The forest of agent threads, retention, and digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from turnlake.sources.tables import checkpointed, discard


def climb(threads: DataFrame, node: str, parent: str, mark: Column | None = None) -> DataFrame:
    """``node, root, depth, descendants, marked`` of every thread, by pointer jumping.

    Each round doubles how far every node sees: ``up`` is the ancestor 2^k steps above, or the root where there is none, and ``below`` the nodes
    less than 2^k steps under it. So the rounds are the logarithm of the deepest path, and each holds one row a node, never its pairs. A thread is
    ``marked`` when ``mark`` holds for it or for any below it. Unknown and own parents end a path; of several rows of a node the least parent
    counts. Nodes on a cycle, or under one, have neither root nor depth.
    """
    flag = F.coalesce(mark, F.lit(False)) if mark is not None else F.lit(False)
    rows = threads.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(F.nullif(parent, node)).alias("p"), F.max(flag).alias("marked"))
    known = rows.select(F.col("node").alias("p"), F.lit(True).alias("known"))
    up = F.when(F.col("known"), F.col("p")).otherwise(F.col("node"))
    state = rows.join(known, "p", "left").select("node", up.alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("steps"), F.lit(1).cast("long").alias("below"), "marked")
    state, reach = checkpointed(state), 1
    most = state.count()
    while reach < most and not (far := state.where(F.col("steps") == reach)).isEmpty():
        gained = far.groupBy(F.col("up").alias("node")).agg(F.sum("below").alias("more"), F.max("marked").alias("any"))
        ahead = state.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("further"))
        new = state.join(gained, "node", "left").join(ahead, "up")
        new = new.select("node", F.col("next").alias("up"), (F.col("steps") + F.col("further")).alias("steps"), (F.col("below") + F.coalesce("more", F.lit(0))).alias("below"), (F.col("marked") | F.coalesce("any", F.lit(False))).alias("marked"))
        last, state, reach = state, checkpointed(new), reach * 2
        discard(last)
    ends = F.col("steps") < most
    return state.select("node", F.when(ends, F.col("up")).alias("root"), F.when(ends, F.col("steps")).cast("int").alias("depth"), (F.col("below") - 1).alias("descendants"), "marked")


def forest(threads: DataFrame, node: str, parent: str) -> DataFrame:
    """``node, root, depth, descendants, orphaned``: a thread whose parent is not in the capture is a root, and orphaned."""
    known = threads.select(F.col(node).alias("_p")).distinct()
    flags = threads.join(known, F.col(parent) == F.col("_p"), "left").groupBy(F.col(node).alias("node")).agg(F.max(F.col(parent).isNotNull() & F.col("_p").isNull()).alias("orphaned"))
    return climb(threads, node, parent).drop("marked").join(flags, "node")


def retained(threads: DataFrame, node: str, parent: str, keep: Column) -> DataFrame:
    """Threads that satisfy ``keep``, and all their ancestors."""
    return climb(threads, node, parent, keep).where("marked").select(F.col("node").alias(node))


def majority(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; of equals the least."""
    n = rows.groupBy(*keys, value).count()
    return n.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("count")).alias("n"), F.col(value))).alias(value), F.max("count").alias("votes"))


def pack_chunks(blocks: DataFrame, keys: list[str], order: str, size: str, most: int) -> DataFrame:
    """Greedy packing of ordered blocks into chunks of at most ``most`` characters; a larger block has a chunk of its own.

    A key's rows stream through one task in order, which holds one batch of them and the chunk that is being filled. Null sizes count as zero.
    """
    rows = blocks.select(*keys, F.col(order).alias("_o"), F.col(size).cast("long").alias("_n"))
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "_o", "_n")
    n_keys, names = len(keys), [*rows.columns, "_chunk"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chunk, used = None, 0, 0
        for batch in batches:
            found = []
            for *key, n in zip(*[batch.column(i).to_pylist() for i in (*range(n_keys), n_keys + 1)], strict=True):
                if key != last:
                    last, chunk, used = key, 0, 0
                n = n or 0
                if used > 0 and used + n > most:
                    chunk, used = chunk + 1, 0
                used += n
                found.append(chunk)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], names)

    packed = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_chunk", IntegerType())]))
    return packed.select(*keys, F.col("_o").cast("long").alias(order), F.col("_chunk").alias("chunk"), F.col("_n").alias(size))
