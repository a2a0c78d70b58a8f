"""Embedding near-duplicates on an inverted multi-index.

A codebook for each half of the vectors makes a grid of cells, and every vector is stored in the cell of its two nearest codewords. A query
walks the grid by multi-sequence traversal: each half's codewords are sorted by how far the half would have to move to change to them, and a
heap merges the two sequences, so that cells come in the order of the sum. The walk stops at the bound that finds the target share of
vectors at the threshold, measured on a sample. Cells have an order and a query visits only cells after its own, so each pair meets once, in
one cell; the pair is then verified in double precision.

Labels are searched apart, and may be of any size: each class of sizes (a power of four) has a grid whose cells hold about the same number
of vectors. Where the sample can't fit that many codewords, cells grow, and are compared in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from turnlake.llm.common import discard, materialize
from turnlake.llm.components import connected_components

#: Vectors that the codebooks and the stopping bound are fitted on: a fixed-size sample by hash; every vector is indexed.
SAMPLE = 8_192
#: Vectors that a cell should hold, and rows of either side that one verification task compares at once.
CELL_ROWS, BLOCK_ROWS = 64, 512
#: Sample vectors that a codeword needs at least: the sample bounds the codebooks, the number of vectors doesn't.
POINTS_A_WORD = 8
TARGET_RECALL = 0.999

Grid = tuple[np.ndarray, np.ndarray, float]  # the two codebooks and the bound


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows of length one; each is scaled by its largest component first, so that no square over- or underflows."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _points(blobs, dim: int) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(blobs), "<f8").reshape(-1, dim))


def _codebook(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from the first ``k`` points; the sample's order is a hash, so they are a random choice."""
    words = points[:k].copy()
    for _ in range(rounds):
        near = ((words * words).sum(1) - 2 * points @ words.T).argmin(1)
        for j in range(len(words)):
            if (mine := near == j).any():
                words[j] = points[mine].mean(0)
    return words


def _moves(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's codeword, and for every codeword the squared distance to the border behind which it would be the nearer one."""
    d = (points * points).sum(1)[:, None] + (words * words).sum(1) - 2 * points @ words.T
    own = d.argmin(1)
    gaps = np.sqrt(np.maximum(((words[:, None] - words[None]) ** 2).sum(2), 1e-300))
    cost = (d - np.take_along_axis(d, own[:, None], 1)) / (2 * gaps[own])
    cost[np.arange(len(points)), own] = 0
    return own, np.square(np.maximum(cost, 0))


def _walk(costs: tuple[np.ndarray, np.ndarray], ranked: tuple[np.ndarray, np.ndarray], bound: float) -> Iterator[tuple[int, int]]:
    """Cells in the order of the sum of two sorted sequences of costs, until it exceeds the bound: multi-sequence traversal."""
    a, b = costs
    heap, done = [(a[0] + b[0], 0, 0)], {(0, 0)}
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > bound:
            return
        yield int(ranked[0][i]), int(ranked[1][j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in done:
                done.add((x, y))
                heapq.heappush(heap, (a[x] + b[y], x, y))


def _cells(points: np.ndarray, grid: Grid) -> tuple[np.ndarray, list[list[int]]]:
    """Each vector's own cell, and the later cells that it visits, nearest first."""
    first, second, bound = grid
    half, width = points.shape[1] // 2, len(second)
    (own_a, cost_a), (own_b, cost_b) = _moves(points[:, :half], first), _moves(points[:, half:], second)
    own = own_a * width + own_b
    near = (cost_a <= bound).sum(1), (cost_b <= bound).sum(1)
    ranked = [np.argsort(c, axis=1, kind="stable")[:, : int(n.max())] for c, n in ((cost_a, near[0]), (cost_b, near[1]))]
    visits: list[list[int]] = [[] for _ in range(len(points))]
    for row in np.flatnonzero((near[0] > 1) | (near[1] > 1)).tolist():
        ra, rb = ranked[0][row, : near[0][row]], ranked[1][row, : near[1][row]]
        cells = (f * width + s for f, s in _walk((cost_a[row, ra].tolist(), cost_b[row, rb].tolist()), (ra, rb), bound))
        visits[row] = [c for c in cells if c > own[row]]
    return own, visits


def fit(sample: np.ndarray, words: int, threshold: float) -> Grid:
    """Codebooks of ``words`` on the halves of the sample, fewer where it is small, and the bound at which :data:`TARGET_RECALL` of neighbours at the threshold are visited.

    A neighbour at the threshold is simulated for every sample vector, in a random direction, and the bound is the quantile of what the
    traversal would have to reach to visit its cell, from whichever of the two cells comes first.
    """
    half = sample.shape[1] // 2
    k = max(1, min(words, len(sample) // POINTS_A_WORD))
    books = (_codebook(sample[:, :half], k), _codebook(sample[:, half:], k))
    rng = np.random.default_rng(0)
    aside = rng.standard_normal(sample.shape)
    aside = _unit(aside - (aside * sample).sum(1, keepdims=True) * sample)
    other = threshold * sample + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside
    needed = np.zeros(len(sample))
    sides = []
    for points in (sample, other):
        sides.append([_moves(p, w) for p, w in zip((points[:, :half], points[:, half:]), books, strict=True)])
    cell = [s[0][0] * k + s[1][0] for s in sides]
    rows = np.arange(len(sample))
    for here, there in ((0, 1), (1, 0)):
        reach = sum(sides[here][h][1][rows, sides[there][h][0]] for h in range(2))
        needed = np.where(cell[here] < cell[there], reach, needed)
    return books[0], books[1], float(np.quantile(needed, TARGET_RECALL))


def _prepare(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, dim, v)``: ``v`` holds the vector's components as bytes (doubles), null when it can link with nothing."""
    v = vectors[vector_col].cast("array<double>")
    source = vectors.select(vectors[id_col].alias("id"), vectors[label_col].cast("string").alias("label"), v.alias("v"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, blobs = [], []
            for label, row in zip(batch.column(1), batch.column(2), strict=True):
                x = None
                if label.is_valid and row.is_valid and row.values.null_count == 0:
                    x = row.values.to_numpy(zero_copy_only=False) + 0.0  # minus zero becomes zero
                    x = x if len(x) and np.isfinite(x).all() and x.any() else None
                dims.append(0 if x is None else len(x))
                blobs.append(None if x is None else x.astype("<f8").tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "dim", "v"])

    return source.mapInArrow(run, f"id {kind}, label string, dim int, v binary")


def _visits(classes: DataFrame, grids: dict[tuple[int, int], Grid]) -> DataFrame:
    """Every class with its own cell and the later cells that it visits; vectors whose size class isn't in the sample share one cell."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for (dim, level), df in whole.groupby(["dim", "level"], sort=False):
                for at in range(0, len(df), 1024):
                    part = df.iloc[at : at + 1024]
                    own, cells = np.zeros(len(part), np.int64), [[]] * len(part)
                    if (dim, level) in grids:
                        own, cells = _cells(_points(part["v"], dim), grids[dim, level])
                    yield part.assign(own=own, cells=cells)

    out = StructType([*classes.schema.fields, StructField("own", LongType()), StructField("cells", ArrayType(LongType()))])
    return classes.mapInPandas(run, out)


def _verify(threshold: float):
    """Compare the block's queries with its stored rows; gives each class's linked vectors and edges that span the block's links."""

    def run(df: pd.DataFrame) -> pd.DataFrame:
        dim = int(df["dim"].iat[0])
        stored, asked = df[df["role"] == 0], df[df["role"] > 0]
        ids, counts = stored["cls"].to_numpy(), stored["n"].to_numpy()
        matrix = _points(stored["v"], dim) if len(stored) else np.zeros((0, dim))
        q_ids, q_counts, own = asked["cls"].to_numpy(), asked["n"].to_numpy(), (asked["role"] == 1).to_numpy()
        names, gains, a, b = [], [], [], []
        for at in range(0, len(asked) if len(stored) else 0, 512):
            part = slice(at, at + 512)
            queries = _points(asked["v"].iloc[part], dim)
            hit = queries @ matrix.T >= threshold
            hit &= ~own[part, None] | (q_ids[part, None] < ids)
            i, j = np.nonzero(hit)
            if len(i):
                left, right = q_ids[part][i], ids[j]
                names += [left, right]
                gains += [counts[j], q_counts[part][i]]
                a.append(left)
                b.append(right)
        out = [pd.DataFrame({"a": [], "b": [], "gain": []}, dtype="int64")]
        if names:
            sums = pd.Series(np.concatenate(gains)).groupby(np.concatenate(names)).sum()
            out.append(pd.DataFrame({"a": sums.index, "b": sums.index, "gain": sums.to_numpy()}))
            left, right = np.concatenate(a), np.concatenate(b)
            nodes, flat = np.unique(np.concatenate([left, right]), return_inverse=True)
            x, y = flat[: len(left)], flat[len(left) :]
            root = np.arange(len(nodes))
            while True:
                low = np.minimum(root[x], root[y])
                new = root.copy()
                np.minimum.at(new, x, low)
                np.minimum.at(new, y, low)
                np.minimum.at(new, root[x], low)
                np.minimum.at(new, root[y], low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            away = root != np.arange(len(nodes))
            out.append(pd.DataFrame({"a": nodes[away], "b": nodes[root[away]], "gain": 0}))
        return pd.concat(out)

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """One row per vector: ``(id, n_links, component_id, kept)``; only vectors of equal, non-null labels are compared.

    ``n_links`` counts the other rows at cosine ``threshold`` or more that were found (none below it counts), ``component_id`` is the
    least id reachable over links and ``kept`` says whether it is the row's own. Equal vectors of a label are one class: they are compared
    once and linked with each other. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and
    neither do vectors of different lengths. Rows without an id still count as links of others, and are kept only when nothing with an id
    is reachable. Other columns are ignored; an empty table gives an empty result.
    """
    prepared = _prepare(vectors, id_col, vector_col, label_col)
    hashes = {f"h{i}": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), "label", "v")) for i in range(2)}  # together 128 bits
    prepared = materialize(prepared.withColumns(hashes), "vectors")
    classes = prepared.where("v is not null").groupBy("label", "dim", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("h0").alias("h0"), F.first("h1").alias("h1"))
    known = classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("size"))
    level = F.greatest(F.ceil(F.log2(F.col("size") / CELL_ROWS) / 2), F.lit(0)).cast("int")  # 4 ** level cells
    classes = classes.join(sizes.select("label", "dim", level.alias("level")), ["label", "dim"])
    taken = classes.orderBy("h0", "h1").limit(SAMPLE).select("dim", "level", "v").toPandas()
    grids: dict[tuple[int, int], Grid] = {}
    for (dim, lv), part in taken.groupby(["dim", "level"]):
        if dim > 1 and lv > 0:
            grids[int(dim), int(lv)] = fit(_points(part["v"], int(dim)), 2 ** int(lv), threshold)

    visited = visits = materialize(_visits(classes.select("cls", "n", "label", "dim", "level", "v"), grids), "visits")
    # the class as a stored row (role 0) and a query (role 1) of its own cell, and as a query (role 2) of the cells it visits
    at = lambda cell, role: F.struct(cell.alias("cell"), F.lit(role).alias("role"))
    places = F.concat(F.array(at(F.col("own"), 0), at(F.col("own"), 1)), F.transform("cells", lambda c: at(c, 2)))
    keys = ["label", "dim", "cell"]
    stored, asked = F.count_if(F.col("role") == 0), F.count_if(F.col("role") > 0)
    size = visits.select("label", "dim", F.explode(places).alias("p")).select("label", "dim", "p.*").groupBy(*keys).agg(stored.alias("s"), asked.alias("q"))
    hot = materialize(size.where(F.greatest("s", "q") > BLOCK_ROWS), "hot")
    visits = visits.select("cls", "n", "label", "dim", "v", F.explode(places).alias("p")).select("cls", "n", "label", "dim", "v", "p.*").join(hot, keys, "left")
    blocks = lambda c: F.coalesce(F.ceil(F.col(c) / BLOCK_ROWS), F.lit(1)).cast("long")
    pick = lambda c: F.array(F.pmod(F.hash("cls"), blocks(c)).cast("long"))
    every = lambda c: F.sequence(F.lit(0).cast("long"), blocks(c) - 1)
    visits = visits.withColumn("s_block", F.explode(F.when(F.col("role") == 0, pick("s")).otherwise(every("s"))))
    visits = visits.withColumn("q_block", F.explode(F.when(F.col("role") == 0, every("q")).otherwise(pick("q")))).drop("s", "q")
    found = visits.groupBy(*keys, "s_block", "q_block").applyInPandas(_verify(threshold), "a long, b long, gain long")
    found = materialize(found, "found")
    discard(visited)
    discard(hot)
    parts = connected_components(found.where("a <> b"))
    gains = found.where("a = b").groupBy(F.col("a").alias("cls")).agg(F.sum("gain").alias("gain"))
    names = classes.select("cls", "h0", "h1", "n", "least")
    member = names.join(parts.withColumnRenamed("node", "cls"), "cls", "left").join(gains, "cls", "left")
    member = materialize(member.withColumn("component", F.coalesce("component", "cls")), "members")
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = materialize(member.join(least, "component").select("h0", "h1", "n", "gain", "component_id"), "groups")
    for done in (known, found, member):
        discard(done)
    rows = prepared.select("id", "h0", "h1")
    alone = rows.where("h0 is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.join(groups, ["h0", "h1"]).select("id", (F.col("n") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"), "component_id")
    return linked.union(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
