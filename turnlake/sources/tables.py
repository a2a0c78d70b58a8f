"""Reading tables and cutting lineage."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names for all executors. Only a session in one process may go without: it gets a local one.

    On a cluster that names none this raises, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (named or os.path.join(tempfile.gettempdir(), "turnlake-shared")).rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/turnlake-cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`checkpointed`, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for parent in {os.path.dirname(f) for f in df.inputFiles()}:
        if "turnlake-cut-" in parent:
            path = jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def since(rows: DataFrame, column: str, last: int) -> DataFrame:
    """Rows beyond a high-water mark; the predicate reaches the scan."""
    return rows.where(f"{column} > {int(last)}")


def read_jdbc(spark: SparkSession, url: str, sql: str, partition_column: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A query's rows from a database, read in parallel ranges of a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({sql}) q", partitionColumn=partition_column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options)
    return reader.load()


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON object a row, for text sinks."""
    return rows.selectExpr("to_json(struct(*)) as value")


_MANIFEST = "_manifest"


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a path: the file system it is on, and the path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def land(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to where a stream looks for it, as one step; says whether there was one."""
    fs, at = _files(spark, source)
    _, to = _files(spark, target)
    if not fs.exists(at):
        return False
    fs.mkdirs(to.getParent())
    return fs.rename(at, to)


def write_batch(tables: dict[str, DataFrame], folder: str, batch: int) -> bool:
    """A sink for ``foreachBatch``: all tables of a batch appear at once to :func:`committed`, or none of them; says whether they appeared now.

    Every table is written to a place of its own that nothing refers to. When all are, one manifest that names these places is renamed into
    view: that is the only step that counts. A batch that has a manifest isn't written again, so a retry gives it once; what an attempt left
    that failed before its manifest is never read.
    """
    if not tables:
        return False
    spark = next(iter(tables.values())).sparkSession
    base = folder.rstrip("/")
    fs, final = _files(spark, f"{base}/{_MANIFEST}/{batch:012d}.json")
    if fs.exists(final):
        return False
    attempt = uuid.uuid4().hex
    places = {name: f"{name}/batch={batch}-{attempt}" for name in tables}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{places[name]}")
    _, draft = _files(spark, f"{base}/{_MANIFEST}/.{attempt}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(places).encode()))
    out.close()
    if fs.rename(draft, final):
        return True
    fs.delete(draft, False)  # another attempt was first
    if not fs.exists(final):
        raise OSError(f"the manifest of batch {batch} could not be put in place")
    return False


def committed(spark: SparkSession, folder: str, name: str, schema: StructType | str, newest: bool = False) -> DataFrame:
    """A table's rows of all batches with a manifest, or of the newest one; without one it is empty. A batch that lacks the table adds nothing."""
    base = folder.rstrip("/")
    fs, at = _files(spark, f"{base}/{_MANIFEST}")
    found = [s.getPath().toString() for s in fs.listStatus(at)] if fs.exists(at) else []
    names = sorted(f for f in found if f.endswith(".json"))[-1 if newest else 0 :]
    places = []
    if names:
        rows = spark.read.text(names, wholetext=True).select(F.get_json_object("value", f"$['{name}']").alias("place")).where("place is not null")
        places = sorted(r[0] for r in rows.collect())  # one a batch
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" for p in places]).select(*[c for c in _names(schema)]) if places else spark.createDataFrame([], schema)


def _names(schema: StructType | str) -> list[str]:
    return (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).names
