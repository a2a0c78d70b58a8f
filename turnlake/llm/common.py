"""Helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule, for Java and Python patterns: words are runs of anything else.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Only where the session names none (as in tests) is a local one made and set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        found = os.path.join(tempfile.gettempdir(), "turnlake-shared")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/turnlake-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table written by :func:`materialize`, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for parent in {os.path.dirname(f) for f in df.inputFiles()}:
        if "turnlake-" in parent:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def word_array(text: str | Column) -> Column:
    """The text's words, runs of characters other than space and \\t..\\r; null and blank texts have none."""
    c = F.col(text) if isinstance(text, str) else text
    trimmed = F.regexp_replace(F.coalesce(c, F.lit("")), f"^[{SPACE}]+", "")
    parts = F.split(trimmed, f"[{SPACE}]+")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    )


def word_count(text: str | Column) -> Column:
    """Number of words, without building them: a word starts wherever a non-space follows a space or the start."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")
