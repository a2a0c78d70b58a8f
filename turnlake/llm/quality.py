"""Quality classifier: a document's own evidence joined with what its host and path are like.

Two logistic heads (quality and toxicity) are fitted on a bounded sample of labelled documents. Their log-odds are the document evidence.
Host and path rates of both come from all documents by grouped aggregation; each level is shrunk towards the one above it (path to host,
host to the whole) with a strength estimated from how much the level's rates vary beyond chance, so that a sparse site says little.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.llm.arrow import text_slices, texts
from turnlake.llm.common import materialize

#: Labelled documents that the heads are fitted on, at most. Every word of theirs with evidence carries weight.
LABELLED = 20_000
#: A word carries weight when the likelihood ratio of its documents against the labels reaches this: a chance of 1 in 16,000 without one.
#: Unlike a standard error, the ratio is sound for words that occur in documents of one label only.
MIN_G2 = 16.0
HEADS = ("quality", "toxic")

_WORD = re.compile(r"[^\W\d_]+")
_SYMBOL = re.compile(r"[#*$%&|<>!]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")

Model = tuple[dict[str, tuple[float, float]], np.ndarray, np.ndarray, np.ndarray]


def _shape(text: str, words: list[str]) -> list[float]:
    """What a text is like apart from its words."""
    n, tokens = max(len(text), 1), text.split()
    k = max(len(tokens), 1)
    return [
        np.log1p(len(tokens)), len(_SYMBOL.findall(text)) / k, len(_UPPER.findall(text)) / n, text.count("|") / k,
        1 - len(set(tokens)) / k, len(text) / k / 10, 1 - len(words) / k,
    ]


def _features(text: str, weights: dict[str, tuple[float, float]]) -> list[float]:
    words = _WORD.findall(text.lower())
    sums = [0.0, 0.0, 0.0, 0.0]
    for w in weights.keys() & set(words):
        for h, x in enumerate(weights[w]):
            sums[2 * h + (x < 0)] += x
    return [*_shape(text, words), *sums]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge that spares the constant."""
    theta, keep = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    keep[0, 0] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + keep, x.T @ (p - y) + keep @ theta)
        theta -= step
        if np.abs(step).max() < 1e-7:
            break
    return theta


def _g2(a: Column, b: Column, yes: int, no: int) -> Column:
    """Likelihood ratio of a word (in ``a`` of ``yes`` and ``b`` of ``no`` documents) against independence; empty cells add nothing."""

    def cell(x: Column, row: Column, column: int) -> Column:
        return F.when(x > 0, x * F.log(x * F.lit(float(yes + no)) / (row * column))).otherwise(0.0)

    out = F.lit(yes + no) - a - b
    return 2 * (cell(a, a + b, yes) + cell(b, a + b, no) + cell(yes - a, out, yes) + cell(no - b, out, no))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Word weights, feature means and spreads, and a weight vector for each head; None without labelled documents.

    Uses the labelled documents with the smallest hashes of their ids and texts, at most :data:`LABELLED`; rows with a null label are left
    out, and of several labels of an id the higher ones count.
    """
    some = labels.select(F.col(id_col).alias("id"), *[F.col(h).cast("int").alias(h) for h in HEADS]).dropna()
    some = some.groupBy("id").agg(*[F.max(h).alias(h) for h in HEADS]).orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    text = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    known = text.join(F.broadcast(some), "id")  # at most LABELLED rows; rows that share an id are as many as they like
    known = materialize(known.orderBy(F.xxhash64("id", "text"), *HEADS).limit(LABELLED).select("text", *HEADS), "labelled")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0):
            found = [sorted(set(_WORD.findall(t.lower()))) for t in texts(batch, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), batch.column(1), batch.column(2)], ["words", *HEADS])

    seen = known.mapInArrow(distinct, "words array<string>, quality int, toxic int").select(F.explode("words").alias("word"), *HEADS)
    counts = seen.groupBy("word").agg(F.count("*").alias("n"), *[F.sum(h).alias(h) for h in HEADS])
    totals = known.agg(F.count("*").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).first()
    if not totals["n"]:
        return None
    weights: dict[str, list[float]] = {}
    for h, head in enumerate(HEADS):
        yes, no = totals[head], totals["n"] - totals[head]
        a, b = F.col(head), F.col("n") - F.col(head)
        odds = F.log((a + 0.5) / (b + 0.5)) - F.lit(float(np.log((yes + 1) / (no + 1))))
        g2 = _g2(a, b, yes, no)
        for r in counts.select("word", odds.alias("odds"), g2.alias("g2")).where(F.col("g2") >= MIN_G2).collect():  # words of at most LABELLED documents
            weights.setdefault(r["word"], [0.0, 0.0])[h] = r["odds"]
    fixed = {w: (x[0], x[1]) for w, x in weights.items()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0):
            rows = [_features(t, fixed) for t in texts(batch, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", *HEADS])

    sample = known.mapInArrow(measure, "x array<double>, quality int, toxic int").toPandas()  # at most LABELLED rows
    x = np.array(sample["x"].tolist())
    mean, spread = x.mean(0), x.std(0) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    return fixed, mean, spread, np.stack([_logistic(x, sample[h].to_numpy(float)) for h in HEADS])


def _evidence(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(id, host, path, l_quality, l_toxic)``: each head's log-odds."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 3):
            logits = np.zeros((batch.num_rows, 2))
            if model and batch.num_rows:
                weights, mean, spread, theta = model
                x = (np.array([_features(t, weights) for t in texts(batch, 3)]) - mean) / spread
                logits = theta[:, 0] + x @ theta[:, 1:].T
            columns = [*batch.columns[:3], *[pa.array(np.clip(logits[:, h], -30, 30)) for h in range(2)]]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", "path", *[f"l_{h}" for h in HEADS]])

    return docs.mapInArrow(run, f"id {kind}, host string, path string, l_quality double, l_toxic double")


def _sites(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(f"p_{h}").alias(f"s_{h}") for h in HEADS])


def _strength(sites: DataFrame, head: str, parent: Column) -> float:
    """Prior strength by moments: pseudo-documents that explain how far the level's rates lie from the parent's, beyond chance."""
    rate = F.col(f"s_{head}") / F.col("n")
    chance = parent * (1 - parent)
    r = sites.where("n > 1").agg(
        F.sum(F.col("n") * (rate - parent) ** 2).alias("seen"), F.sum(chance).alias("noise"), F.sum("n").alias("n"), F.sum(F.col("n") * chance).alias("c")
    ).first()
    if not r["n"]:
        return 10.0
    between = (r["seen"] - r["noise"]) / r["n"]
    return float(min(1e6, max(1.0, r["c"] / r["n"] / between - 1))) if between > 1e-12 else 1e6


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "to_json(struct(source, lang))", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, quality_score, toxic_score, kept)``, one row per document: posterior probabilities, and whether it is good and not toxic.

    ``host`` and ``path`` are SQL expressions of the site that a document is from; null counts as one site of its own. Null and empty texts
    are scored like any other. A document's own evidence is left out of its path's rate, so that it isn't counted twice. Repeated rows and
    null ids stay; other columns are ignored; without labels every document scores one half for quality and is kept; an empty table gives
    an empty result.
    """
    model = fit(docs, labels, id_col, text_col)
    site = lambda e: F.coalesce(F.concat(F.lit("="), F.expr(e).cast("string")), F.lit(""))
    source = docs.select(docs[id_col].alias("id"), site(host).alias("host"), site(path).alias("path"), docs[text_col].cast("string").alias("text"))
    odds = _evidence(source, model)
    rows = materialize(odds.withColumns({f"p_{h}": 1 / (1 + F.exp(-F.col(f"l_{h}"))) for h in HEADS}), "evidence")
    whole = rows.agg(*[F.avg(f"p_{h}").alias(h) for h in HEADS]).first()
    rate = {h: min(max(whole[h] if whole[h] is not None else 0.5, 1e-4), 1 - 1e-4) for h in HEADS}
    paths = materialize(_sites(rows, ["host", "path"]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"s_{h}").alias(f"s_{h}") for h in HEADS])
    for h in HEADS:
        k = _strength(hosts, h, F.lit(rate[h]))
        hosts = hosts.withColumn(f"h_{h}", (F.col(f"s_{h}") + k * rate[h]) / (F.col("n") + k))
    paths = paths.join(hosts.select("host", *[f"h_{h}" for h in HEADS]), "host")
    paths = materialize(paths, "posteriors")
    for h in HEADS:
        paths = paths.withColumn(f"k_{h}", F.lit(_strength(paths, h, F.col(f"h_{h}"))))
    joined = rows.join(paths, ["host", "path"])
    logit = lambda p: F.log(p / (1 - p))
    for h in HEADS:
        others = (F.col(f"s_{h}") - F.col(f"p_{h}") + F.col(f"k_{h}") * F.col(f"h_{h}")) / (F.col("n") - 1 + F.col(f"k_{h}"))
        others = F.greatest(F.least(others, F.lit(1 - 1e-4)), F.lit(1e-4))
        joined = joined.withColumn(f"{h}_score", 1 / (1 + F.exp(-(F.col(f"l_{h}") + logit(others) - float(np.log(rate[h] / (1 - rate[h])))))))
    kept = (F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5) if model else F.lit(True)
    return joined.select(F.col("id").alias(id_col), "quality_score", "toxic_score", kept.alias("kept"))
