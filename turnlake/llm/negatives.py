"""Hard negatives by Kronecker-packed products.

Scores are integer inner products. The components of a block of candidates are biased to be non-negative and put into separated fields of
one wide integer for each dimension; multiplying that integer by an anchor's biased component multiplies all fields at once, and the sum over
the dimensions holds every candidate's score in its own field, plus what the biases add, which is known and taken off. Fields are as wide as
the block's largest possible sum, so none runs over into the next, and the scores are exact.

An anchor meets the rows of its label once, for its positives, and all rows once, for the negatives within the windows that the positives'
scores open. Both are done block by block on a grid of anchor blocks and row blocks; each block gives its few best rows for each anchor, and a
window over these picks the best of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.llm.common import materialize

#: Rows and anchors of a block: what one task holds of either side.
BLOCK_ROWS, BLOCK_ANCHORS = 2_048, 512
#: Candidates whose components share an integer.
FIELDS = 512
#: The largest sum of squares of a row's components: scores of any two rows then fit in 63 bits.
MAX_SQUARES = 2**63 - 1


class PackedBlock:
    """Candidates' components (rows of integers) packed by dimension, to be multiplied with anchors whose components are at most ``reach``."""

    def __init__(self, rows: np.ndarray, reach: int) -> None:
        self.n, dims = rows.shape
        self.reach = reach
        self.bias = max(0, -int(rows.min(initial=0)))
        most = dims * (int(rows.max(initial=0)) + self.bias) * 2 * reach
        self.width = max(1, -(-most.bit_length() // 8))  # bytes of a field
        fields = np.zeros((dims, self.n, self.width), np.uint8)
        if self.n and dims:
            low = (rows.T + self.bias).astype("<u8")  # at most 2 ** 33
            inner = min(self.width, 8)
            fields[:, :, :inner] = np.ascontiguousarray(low)[:, :, None].view(np.uint8)[:, :, :inner]
        self.packed = [int.from_bytes(f.tobytes(), "little") for f in fields]
        #: What the anchor's bias adds to each score.
        self.sums = (rows + self.bias).sum(1)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner products of ``anchor`` with every row of the block."""
        biased = [a + self.reach for a in anchor]
        total = sum(map(mul, biased, self.packed))
        raw = np.frombuffer(total.to_bytes(self.n * self.width, "little"), np.uint8).reshape(self.n, self.width)
        whole = np.zeros((self.n, 16), np.uint8)
        whole[:, : self.width] = raw
        low, high = whole.view("<u8").T
        # modulo 2 ** 64, in which the score itself is exact
        offset = (self.bias * sum(anchor)) % 2**64
        return (low - np.uint64(offset) - np.uint64(self.reach % 2**64) * self.sums.astype(np.uint64)).view(np.int64)


def _best(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Of the rows ``among`` (in order of preference when scores are equal), the ``k`` with the highest scores."""
    if len(among) > 8 * k:
        floor = np.partition(scores[among], len(among) - k)[len(among) - k]
        among = among[scores[among] >= floor]
    return among[np.argsort(-scores[among], kind="stable")[:k]]


def _blocks(df: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, pd.DataFrame, np.ndarray]:
    """The group's stored rows by (id, null last, then row), its anchors, and the components of both."""
    dim = int(df["dim"].iat[0])
    stored = df[df["role"] == 0].sort_values(["id", "at"], na_position="last")
    asked = df[df["role"] == 1]
    read = lambda part: np.frombuffer(b"".join(part["v"]), "<i8").reshape(len(part), dim)
    return stored, read(stored), asked, read(asked)


def _scored(stored: np.ndarray, asked: np.ndarray) -> Iterator[np.ndarray]:
    """Each anchor's scores with all stored rows."""
    reach = int(np.abs(asked).max(initial=0))
    packs = [PackedBlock(stored[k : k + FIELDS], reach) for k in range(0, len(stored), FIELDS)]
    for anchor in asked.tolist():
        yield np.concatenate([p.scores(anchor) for p in packs]) if packs else np.zeros(0, np.int64)


def _positives(k: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        stored, rows, asked, anchors = _blocks(df)
        at, out = stored["at"].to_numpy(), []
        for me, scores in zip(asked["at"].tolist(), _scored(rows, anchors), strict=True):
            best = _best(scores, np.flatnonzero(at != me), k)
            out.append(pd.DataFrame({"anchor": me, "at": at[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "at": [], "score": []}, dtype="int64")

    return run


def _negatives(k: int, low: int, high: int):
    def run(df: pd.DataFrame) -> pd.DataFrame:
        stored, rows, asked, anchors = _blocks(df)
        at, labels = stored["at"].to_numpy(), stored["label"].to_numpy()
        names, floors, found, kept = [], [], [], []
        for me, label, windows, scores in zip(asked["at"].tolist(), asked["label"], asked["windows"], _scored(rows, anchors), strict=True):
            other = labels != label
            for positive in map(int, windows):
                among = np.flatnonzero(other & (scores >= -(-low * positive // 100)) & (scores <= high * positive // 100))
                best = _best(scores, among, k)
                names += [me] * len(best)
                floors += [positive] * len(best)
                found.append(at[best])
                kept.append(scores[best])
        join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int64)
        return pd.DataFrame({"anchor": np.array(names, np.int64), "positive_score": np.array(floors, np.int64), "at": join(found), "score": join(kept)})

    return run


def _prepare(vectors: DataFrame, id_col: str, vector_col: str, label: Column, anchors: Column, scale: int) -> DataFrame:
    """``(at, id, label, asked, dim, v)`` of the rows that take part; ``v`` holds the scaled components as bytes of 64-bit integers."""
    source = vectors.select(
        vectors[id_col].alias("id"), label.cast("string").alias("label"), F.coalesce(anchors, F.lit(False)).alias("asked"),
        vectors[vector_col].cast("array<double>").alias("v"), F.monotonically_increasing_id().alias("at"),
    )
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, blobs = [], []
            for name, row in zip(batch.column(1), batch.column(3), strict=True):
                v = None
                if name.is_valid and row.is_valid and row.values.null_count == 0:
                    x = np.floor(row.values.to_numpy(zero_copy_only=False) * float(scale))
                    if np.isfinite(x).all() and np.abs(x).max(initial=0) < 2.0**32:
                        v = x.astype("<i8")
                        v = v if sum(c * c for c in v.tolist()) <= MAX_SQUARES else None
                dims.append(0 if v is None else len(v))
                blobs.append(None if v is None else v.tobytes())
            columns = [batch.column(4), batch.column(0), batch.column(1), batch.column(2), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["at", "id", "label", "asked", "dim", "v"])

    return source.mapInArrow(run, f"at long, id {kind}, label string, asked boolean, dim int, v binary").where("v is not null")


def _grid(stored: DataFrame, asked: DataFrame, keys: list[str], extra: dict[str, str]) -> DataFrame:
    """Rows (role 0) and anchors (role 1), each with a block number of its own kind and once for every block of the other kind in its keys."""
    some = lambda df, n, name: df.groupBy(*keys).agg(F.ceil(F.count("*") / n).cast("int").alias(name))
    sizes = some(stored, BLOCK_ROWS, "row_blocks").join(some(asked, BLOCK_ANCHORS, "anchor_blocks"), keys)
    pick = lambda n: F.pmod(F.xxhash64("at"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = lambda df: [*dict.fromkeys([*keys, "at", "id", "label", "dim", "v"])] + [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in extra.items()]
    left = stored.join(sizes, keys).select(*columns(stored), F.lit(0).alias("role"), pick("row_blocks").alias("r"), every("anchor_blocks").alias("a"))
    right = asked.join(sizes, keys).withColumn("r", every("row_blocks"))
    right = right.select(*columns(asked), F.lit(1).alias("role"), "r", pick("anchor_blocks").alias("a"))
    parts = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few bytes but much work: partitions aren't to be merged
    return left.union(right).repartition(parts, *keys, "r", "a")


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "at")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
) -> DataFrame:
    """Hard negatives: ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)``; a score is the integer inner product, higher is nearer, ties go to the smaller id (null last, then
    in no stated order). Rows for which ``anchors`` is true are anchors. An anchor's positives are its first ``positives`` other rows of its
    ``label``; for each, the first ``negatives`` rows of other labels whose score is within ``window`` percent of the positive's are given, in
    order. A positive without such a row gives none; below a score of zero no window is open.

    Rows with a null label, a null vector or any null or non-finite component take no part, and neither do those whose scaled components have
    a sum of squares beyond 63 bits, as no long could hold their scores. Rows are compared with rows of the same length. A row is told from
    others by its place: of rows with one id each is a row. A row with a null id can be a positive or a negative. Other columns are ignored;
    an empty table gives an empty result.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = materialize(_prepare(vectors, id_col, vector_col, label, anchors, scale), "scaled")
    asked = rows.where("asked")

    near = _grid(rows, asked, ["dim", "label"], {}).groupBy("dim", "label", "r", "a").applyInPandas(_positives(positives), "anchor long, at long, score long")
    near = near.join(rows.select("at", "id"), "at")
    near = materialize(_first(near, ["anchor"], positives).select("anchor", F.col("id").alias("positive_id"), F.col("rank").alias("nth"), F.col("score").alias("positive_score")), "positives")

    windows = near.groupBy("anchor").agg(F.collect_set("positive_score").alias("windows"))  # at most as many as positives
    opened = asked.join(windows, asked["at"] == windows["anchor"]).drop("anchor")
    grid = _grid(rows, opened, ["dim"], {"windows": "array<bigint>"})
    hard = grid.groupBy("dim", "r", "a").applyInPandas(_negatives(negatives, *window), "anchor long, positive_score long, at long, score long")
    hard = _first(hard.join(rows.select("at", "id"), "at"), ["anchor", "positive_score"], negatives)
    hard = hard.select("anchor", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select(F.col("at").alias("anchor"), F.col("id").alias("anchor_id"))
    out = names.join(near, "anchor").join(hard, ["anchor", "positive_score"])
    return out.select(F.col("anchor_id").cast(kind).alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score")
