"""Connected components by alternating star operations on an edge table that stays distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.llm.common import discard, materialize

#: Rows that one file of an intermediate edge table should hold: small tables are not spread over many tasks.
_FILE_ROWS = 200_000


def _star(edges: DataFrame, neighbours: DataFrame, keep: Column, files: int) -> DataFrame:
    """Point neighbours of each node at the least of them. ``neighbours``: (u, v), each edge seen from u.

    The least neighbours are written first, so that the join shuffles both sides and Spark can split a hub's partition.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = materialize(least.coalesce(files), "least")
    out = neighbours.join(least, "u").where(keep).select(F.greatest("v", "m").alias("a"), F.least("v", "m").alias("b"))
    own = least.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))
    result = materialize(out.unionByName(own).where("a <> b").distinct().coalesce(files), "edges")
    discard(least)
    discard(edges)
    return result


def _is_starred(edges: DataFrame) -> bool:
    """Whether every node has one parent and no parent is a child."""
    rows, children = edges.agg(F.count("*"), F.countDistinct("a")).first()
    return rows == children and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Columns ``a`` and ``b`` of one orderable type in; ``(node, component)`` out, the component being its least node.

    Nodes without an edge do not appear. Loops, repeated edges and either direction are allowed; edges with a null end are ignored; an
    empty table gives an empty result. Every round shortens the trees, and the loop ends when all are stars: the number of rounds grows
    with the logarithm of the longest path. Nothing but a few numbers a round reaches the driver.
    """
    flat = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    flat = materialize(flat, "edges")
    files = max(4, flat.count() // _FILE_ROWS)
    while not _is_starred(flat):
        both = flat.select(F.col("a").alias("u"), F.col("b").alias("v")).union(flat.select("b", "a"))
        flat = _star(flat, both, F.expr("v > u"), files)
        flat = _star(flat, flat.select(F.col("a").alias("u"), F.col("b").alias("v")), F.expr("v < u"), files)
    roots = flat.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return flat.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
