"""An index of which archives hold an id: one Bloom filter a file, in blocks, as a table that is probed before any archive is opened.

Ids are runs of letters, digits, ``_`` and ``-`` with a digit among them. A file's filter has a power of two of blocks; an id sets a few bits in
the one block that its hash picks, so a probe reads one row a file. The table is partitioned by the number of blocks and sorted by the block: a probe's
predicates reach the scan and skip nearly all of it. Files that are new since the last time are added without reading the others again.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.sources.frames import archive_lines, decode
from turnlake.sources.tables import shared_dir

#: Bits of a block, bits that an id sets in it, and bits that a file's filter has for each of its ids, at least.
BLOCK_BITS, SET_BITS, BITS_AN_ID = 4096, 6, 12
#: Ids that a probe compares as literals, and archives that a scan is given by name; beyond these a join and the whole folder take their place.
MOST_LITERALS, MOST_FILES = 16, 10_000
#: A file has fewer than two to this many blocks.
_MOST_BLOCKS = 40

_ID_CHARS = "A-Za-z0-9_-"
_SCHEMA = "file string, ids long, blocks long, block long, words map<int,bigint>"


def ids_in(raw: Column) -> Column:
    """The ids in a line. What follows an escape such as ``\\n`` counts with and without the escape's letters."""
    found = F.regexp_extract_all(raw, F.lit(rf"\\?[{_ID_CHARS}]*[0-9][{_ID_CHARS}]*"), F.lit(0))

    def parts(t: Column) -> Column:
        plain = F.substr(t, F.lit(2))
        after = F.when(F.substr(t, F.lit(2), F.lit(1)) == "u", F.array(plain, F.substr(t, F.lit(7)), F.substr(t, F.lit(3)))).otherwise(F.array(plain, F.substr(t, F.lit(3))))
        return F.when(t.startswith("\\"), after).otherwise(F.array(t))

    return F.array_distinct(F.flatten(F.transform(found, parts)))


def holds(raw: Column, wanted: str) -> Column:
    """Whether a line has the id, whole."""
    return raw.contains(wanted) & F.regexp_like(raw, F.lit(rf"(?:^|[^{_ID_CHARS}]|\\[nrtbf]|\\u[0-9a-fA-F]{{4}}){re.escape(wanted)}(?![{_ID_CHARS}])"))


def _hashes(token: Column) -> tuple[Column, Column]:
    return F.xxhash64(token), F.xxhash64(F.lit("bits"), token)


def _bits(second: Column) -> Column:
    """The places in its block that an id sets: twelve bits of its second hash each; places may meet."""
    return F.array(*[F.shiftrightunsigned(second, 10 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(SET_BITS)])


def build(lines: DataFrame) -> DataFrame:
    """The index of lines ``(file, raw)``: ``file, ids, blocks, block, words``, where ``words`` has a block's bits by 64.

    A file without ids has one row, with no blocks. Lines are read once more to count a file's ids; null lines hold none.
    """
    tokens = lines.select("file", F.explode_outer(ids_in(F.coalesce("raw", F.lit("")))).alias("t"))
    first, second = _hashes(F.col("t"))
    keys = tokens.select("file", F.when(F.col("t").isNotNull(), first).alias("h"), F.when(F.col("t").isNotNull(), second).alias("b")).distinct()
    sizes = keys.groupBy("file").agg(F.count("h").alias("ids"))
    need = F.greatest(F.col("ids") * BITS_AN_ID / BLOCK_BITS, F.lit(1.0))
    sizes = sizes.withColumn("blocks", F.when(F.col("ids") > 0, F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("long")).otherwise(0))
    rows = keys.join(sizes, "file").select("file", "ids", "blocks", F.pmod("h", F.nullif("blocks", F.lit(0))).alias("block"), F.explode_outer(_bits(F.col("b"))).alias("bit"))
    word, mask = F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, bit & 63)")
    words = rows.groupBy("file", "ids", "blocks", "block", word).agg(F.bit_or(mask).alias("bits"))
    pairs = F.filter(F.collect_list(F.struct("word", "bits")), lambda p: p["word"].isNotNull())
    return words.groupBy("file", "ids", "blocks", "block").agg(F.map_from_entries(pairs).alias("words"))


def update(spark: SparkSession, archives: str, folder: str, names: str = "*.jsonl.gz") -> int:
    """Index the archives below a path that aren't in the table at ``folder`` yet; returns how many were read.

    A batch is one write, so a table never has half a batch; an archive that has grown must be indexed under a new name or anew.
    """
    lines = archive_lines(spark, archives, names)
    there = spark.createDataFrame([(f,) for f in sorted(lines.inputFiles())], "path string").withColumn("file", _plain(F.col("path")))
    known = read(spark, folder).select(_plain(F.col("file")).alias("file")).distinct()
    new = [r["path"] for r in there.join(known, "file", "left_anti").collect()]
    if new:
        rows = build(archive_lines(spark, new)).repartitionByRange("blocks", "block", "file").sortWithinPartitions("blocks", "block", "file")
        rows.write.mode("append").partitionBy("blocks").option("parquet.block.size", 8 << 20).parquet(folder)
    return len(new)


def _plain(path: Column) -> Column:
    """A path in one form: local ones come with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The index at a folder; empty where there is none yet."""
    try:
        return spark.read.schema(_SCHEMA).parquet(folder).select("file", "ids", "blocks", "block", "words")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)


def _tokens(wanted: str) -> list[str]:
    return [t for t in re.findall(f"[{_ID_CHARS}]+", wanted) if re.search("[0-9]", t)]


def _set(words: Column, bits: Column | list[int]) -> Column:
    at = [F.lit(b) for b in bits] if isinstance(bits, list) else [F.get(bits, F.lit(i)) for i in range(SET_BITS)]
    test = [F.coalesce(F.getbit(F.try_element_at(words, F.shiftright(b, 6)), b.bitwiseAND(F.lit(63))) == 1, F.lit(False)) for b in at]
    out = test[0]
    for t in test[1:]:
        out = out & t
    return out


def candidates(index: DataFrame, wanted: list[str] | DataFrame) -> DataFrame:
    """``(id, file)``: the files that may hold each id, and all those that do. A filter lets some two in a thousand others pass.

    ``wanted`` is a list of ids or a table ``(id)``. An id of several runs must have all that are indexed; one without a digit may be anywhere.
    """
    spark = index.sparkSession
    if isinstance(wanted, list) and len(wanted) <= MOST_LITERALS:
        runs = [(w, t) for w in dict.fromkeys(wanted) for t in dict.fromkeys(_tokens(w))]
        hashed = [_hashes(F.lit(t)) for _, t in runs]
        known = spark.sql("select 1").select(*[c.alias(f"h{i}") for i, (h, b) in enumerate(hashed) for c in (h, _bits(b))]).first() if runs else ()
        named = {int(x[1]) for f in index.inputFiles() if (x := re.search(r"/blocks=(\d+)/", f))}
        sizes = sorted(named - {0}) or [1 << k for k in range(_MOST_BLOCKS)]  # a table that isn't from a folder doesn't say
        near, tests = F.lit(False), []
        for (w, t), h, bits in zip(runs, known[::2], known[1::2], strict=True):
            for n in sizes:
                near = near | ((F.col("blocks") == n) & (F.col("block") == h % n))  # these reach the scan
            ok = (F.pmod(F.lit(h), F.col("blocks")) == F.col("block")) & _set(F.col("words"), list(bits))
            tests.append(F.when(ok, F.struct(F.lit(w).alias("id"), F.lit(t).alias("t"), F.lit(len([x for x in runs if x[0] == w])).alias("need"))))
        out = None
        if runs:
            found = index.where(near).select("file", F.explode(F.array_compact(F.array(*tests))).alias("p")).select("file", "p.*")
            single = len({w for w, _ in runs}) == len(runs)  # a file has one row for a block
            out = found.select("id", "file") if single else found.groupBy("id", "file", "need").agg(F.count_distinct("t").alias("n")).where("n = need").select("id", "file")
        bare = [w for w in dict.fromkeys(wanted) if not _tokens(w)]
        if not bare:
            return out if out is not None else spark.createDataFrame([], "id string, file string")
        anywhere = spark.createDataFrame([(w,) for w in bare], "id string")
    else:
        ids = (spark.createDataFrame([(w,) for w in wanted], "id string") if isinstance(wanted, list) else wanted.select("id")).distinct()
        runs = ids.withColumn("ts", F.array_distinct(F.regexp_extract_all("id", F.lit(f"[{_ID_CHARS}]*[0-9][{_ID_CHARS}]*"), F.lit(0))))
        first, second = _hashes(F.col("t"))
        one = runs.select("id", F.size("ts").alias("need"), F.explode("ts").alias("t"))
        sizes = index.where("blocks > 0").select("blocks").distinct()
        probes = one.crossJoin(F.broadcast(sizes)).select("id", "need", "t", "blocks", F.pmod(first, "blocks").alias("block"), _bits(second).alias("bits"))  # sizes: some forty powers of two
        hits = index.join(probes, ["blocks", "block"]).where(_set(F.col("words"), F.col("bits")))
        out = hits.groupBy("id", "file", "need").agg(F.count_distinct("t").alias("n")).where("n = need").select("id", "file")
        anywhere = runs.where("size(ts) = 0").select("id")
    files = index.select("file").distinct()
    anywhere = anywhere.crossJoin(files)  # ids that are no ids: a caller's few
    return anywhere if out is None else out.unionAll(anywhere)


def lookup(spark: SparkSession, archives: str, folder: str, wanted: str, names: str = "*.jsonl.gz") -> DataFrame:
    """Decoded frames of every request with a line that has the id, as :func:`turnlake.sources.frames.lookup` finds them in all archives.

    The index at ``folder`` names the archives to search, and once their requests are known, those to read them from: a request may go on in
    another archive than the one with the id. Archives that aren't indexed aren't read.
    """
    index = read(spark, folder)
    rid = F.regexp_extract("raw", r'"request_id"\s*:\s*"([^"\\]*)"', 1)
    named = _named(spark, archives, candidates(index, [wanted]), names).where(holds(F.col("raw"), wanted))
    hits = named.select(rid.alias("id")).where("id <> ''").distinct()
    some = [r[0] for r in hits.limit(MOST_LITERALS + 1).collect()]
    if len(some) > MOST_LITERALS:
        return decode(_named(spark, archives, candidates(index, hits), names).withColumn("id", rid).join(hits, "id", "left_semi").drop("id"))
    one = F.lit(False)
    for r in some:
        one = one | F.col("raw").contains(r)
    return decode(_named(spark, archives, candidates(index, some), names).where(one & rid.isin(some)))


def _named(spark: SparkSession, archives: str, found: DataFrame, names: str) -> DataFrame:
    """The lines of the files that a probe found: their list is given to the scan, or if it is long, joined with what the folder holds."""
    files = found.select("file").distinct()
    few = sorted(r[0] for r in files.limit(MOST_FILES + 1).collect())
    if len(few) > MOST_FILES:
        lines = archive_lines(spark, archives, names).join(files, "file", "left_semi")
    else:
        lines = archive_lines(spark, few) if few else spark.createDataFrame([], "file string, frame_seq long, raw string")
    return lines.withColumn("file", F.element_at(F.split("file", "/"), -1))


def index_folder(spark: SparkSession, name: str) -> str:
    """A place for an index in the shared folder."""
    return f"{shared_dir(spark)}/turnlake-index-{name}"
