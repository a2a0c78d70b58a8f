"""Language-model scores by deleted interpolation.

    p1(w)       = m * c(w) / N + (1 - m) / (V + 1)
    p2(w | v)   = a[b(v)] * c(v w) / c(v) + (1 - a[b(v)]) * p1(w)
    p3(w | u v) = d[b(u v)] * c(u v w) / c(u v) + (1 - d[b(u v)]) * p2(w | v)

``b`` is the frequency bucket of the context (the bit length of its count). The weights are learned by expectation-maximisation on counts
that are held out of the training part itself: every training token in turn is deleted from all counts it is in, and what the rest of the
training part says of it is what the weights are fitted to. Documents outside the training part teach the model nothing.

Documents are cut into chunks of tokens, each with its own small vocabulary. A chunk asks for its distinct words once, by digest, and gets
their numbers and counts; then for its distinct trigrams once, as numbers grouped below their first two words. Keys go out in messages, one
for each range of keys that the chunk has any in; a range adds up the training counts it is sent, once for each chunk that has the key, and
answers every message. So what moves is each chunk's distinct keys and the counts, never a row for each token, and a frequent word or phrase
costs a chunk one key. A range has about :data:`RANGE_KEYS` keys, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.llm.arrow import text_slices, texts
from turnlake.llm.common import discard, materialize

#: Tokens after which a chunk ends; a longer document is a chunk of its own.
CHUNK_TOKENS = 1 << 19
#: Keys that a range gets on average: a task of a counting stage holds one range at a time.
RANGE_KEYS = 1 << 19
MIN_RANGES = 16
#: Numbers of no word and of the place before a text's first word; words count on from the next.
NONE, BEGIN, FIRST = 0, 1, 2
#: The mark that ends a text: no word holds white space.
END = b" "
#: Likelihood ratios are counted in steps of this fraction of a power of two; the bins, and so what reaches the driver, are bounded.
_STEPS, _SPAN = 128, 40


def pack(values: np.ndarray, kind: str) -> bytes:
    """Integers as compressed byte planes: what compresses well lies together."""
    planes = np.ascontiguousarray(values, kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(blob: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(blob[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(blob[8:], decompressed_size=n * size, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _range(digests: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each digest; ranges are in the digests' order."""
    return ((digests >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A digest of each ordered pair of numbers."""
    x = (first + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15) ^ second
    for shift in (32, 29, 32):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Chunk:
    """Documents of one side of the split, until they have enough tokens."""

    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.words: dict[bytes, int] = {END: 0}
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc, text: str) -> None:
        words = self.words
        local = [words.setdefault(w, len(words)) for w in text.encode("utf-8", "surrogatepass").lower().split()]
        local.append(0)
        self.ids.append(doc)
        self.lengths.append(len(local))
        self.tokens.append(np.array(local, "<u4"))
        self.size += len(local)

    def row(self, name: str, held: bool, id_type: pa.DataType) -> pa.RecordBatch:
        digests = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        order = np.argsort(digests)
        place = np.argsort(order).astype("<u4")
        columns = {
            "chunk": pa.array([name]),
            "held": pa.array([held]),
            "ids": pa.array([self.ids], pa.list_(id_type)),
            "lengths": pa.array([self.lengths], pa.list_(pa.int64())),
            "n_words": pa.array([len(self.words)], pa.int64()),
            "words": pa.array([pack(np.diff(digests[order], prepend=np.uint64(0)), "<u8")], pa.binary()),
            "tokens": pa.array([pack(place[np.concatenate(self.tokens)], "<u4")], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def chunks(docs: DataFrame, id_col: str, text_col: str, held: str, most: int = CHUNK_TOKENS) -> DataFrame:
    """One row for each chunk: its documents' ids and token counts, its words' sorted digests (as steps), and its tokens as indices into them."""
    flag = F.coalesce(F.expr(held).cast("boolean"), F.lit(False))
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), flag.alias("held"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, id_type = TaskContext.get().partitionId(), 0, pa.null()
        filling = {False: _Chunk(), True: _Chunk()}
        for batch in text_slices(batches, 1):
            id_type = batch.column(0).type
            for held_out, doc, text in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(), texts(batch, 1), strict=True):
                filling[held_out].add(doc, text)
                if filling[held_out].size >= most:
                    yield filling[held_out].row(f"{part}-{made}", held_out, id_type)
                    filling[held_out], made = _Chunk(), made + 1
        for held_out, rest in filling.items():
            if rest.ids:
                yield rest.row(f"{part}-{made}", held_out, id_type)
                made += 1

    schema = f"chunk string, held boolean, ids array<{kind}>, lengths array<long>, n_words long, words binary, tokens binary"
    return source.mapInArrow(run, schema)


def _each(frames: Iterator[pd.DataFrame], make: Callable) -> Iterator[pd.DataFrame]:
    for df in frames:
        for r in df.itertuples(index=False):
            yield make(r)


def _cuts(sorted_ranges: np.ndarray) -> list[tuple[int, slice]]:
    """The ranges that occur, each with where its rows are."""
    found, starts = np.unique(sorted_ranges, return_index=True)
    return [(int(r), slice(a, b)) for r, a, b in zip(found, starts, [*starts[1:], len(sorted_ranges)], strict=True)]


def _word_requests(table: DataFrame, ranges: int) -> DataFrame:
    """A message from each chunk to each range that it has words in: their sorted digests, and how often the chunk has them."""

    def make(r) -> pd.DataFrame:
        keys, local = np.cumsum(unpack(r.words, "<u8"), dtype=np.uint64), unpack(r.tokens, "<u4")
        counts = np.bincount(local, minlength=len(keys))
        rows = [[i, r.chunk, r.held, pack(np.diff(keys[s], prepend=np.uint64(0)), "<u8"), pack(counts[s], "<u4")] for i, s in _cuts(_range(keys, ranges))]
        return pd.DataFrame(rows, columns=["range", "chunk", "held", "words", "n"])

    schema = "range long, chunk string, held boolean, words binary, n binary"
    return table.select("chunk", "held", "words", "tokens").mapInPandas(lambda frames: _each(frames, make), schema)


def _bins(ratio: np.ndarray) -> np.ndarray:
    """Bins of likelihood ratios on a logarithmic scale; zero has its own."""
    with np.errstate(divide="ignore"):
        log = np.log2(ratio)
    return np.where(ratio > 0, np.clip(np.rint(log * _STEPS), -_SPAN * _STEPS, _SPAN * _STEPS), -_SPAN * _STEPS - 1).astype(np.int64)


def _ratio(bins: np.ndarray) -> np.ndarray:
    return np.where(bins < -_SPAN * _STEPS, 0.0, np.exp2(bins / _STEPS))


def _answer_words(ranges: int) -> Callable:
    """Add up one range's training counts and answer every message with numbers and counts; frequent words get small numbers.

    A row without a chunk carries the range's totals, and its tokens by what is left of their word's count when they are deleted.
    """

    def run(df: pd.DataFrame) -> pd.DataFrame:
        here, training = int(df["range"].iat[0]), ~df["held"].to_numpy(bool)
        keys, times = [np.cumsum(unpack(x, "<u8"), dtype=np.uint64) for x in df["words"]], [unpack(x, "<u4").astype(np.int64) for x in df["n"]]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        mine = np.repeat(training, [len(k) for k in keys])
        sums = np.bincount(where, weights=np.concatenate(times) * mine, minlength=len(distinct)).astype(np.int64)
        rank = np.empty(len(distinct), np.int64)
        rank[np.argsort(-sums, kind="stable")] = np.arange(len(distinct))
        number = np.where(sums > 0, FIRST + rank * ranges + here, NONE)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        numbers = [pack(x, "<u8") for x in np.split(number[where], ends)]
        counts = [pack(x, "<u8") for x in np.split(sums[where], ends)]
        seen = sums[sums > 0]
        b, at = np.unique(_bins((seen - 1).astype(float)), return_inverse=True)
        weight = np.bincount(at, weights=seen, minlength=len(b)).astype(np.int64)
        none = [[]] * len(df)
        out = pd.DataFrame({"range": df["range"], "chunk": df["chunk"], "numbers": numbers, "counts": counts, "total": 0, "distinct": 0, "bins": none, "bin_n": none})
        totals = [here, None, b"", b"", int(seen.sum()), len(seen), b.tolist(), weight.tolist()]
        return pd.concat([out, pd.DataFrame([totals], columns=out.columns)])

    return run


def _numbered(table: DataFrame, replies: DataFrame) -> DataFrame:
    """The chunks with their words' numbers and counts in place of the digests."""

    def make(r) -> pd.DataFrame:
        answers = sorted(r.answers, key=lambda a: a["range"])
        out = [r.chunk, r.held, r.ids, r.lengths, r.tokens]
        for side in ("numbers", "counts"):
            values = np.concatenate([unpack(a[side], "<u8") for a in answers])
            if len(values) != r.n_words:
                raise ValueError(f"chunk {r.chunk} got {len(values)} answers for {r.n_words} words")
            out.append(pack(values, "<u8"))
        return pd.DataFrame([out], columns=["chunk", "held", "ids", "lengths", "tokens", "numbers", "counts"])

    answers = replies.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("range", "numbers", "counts")).alias("answers"))
    kind = table.schema["ids"].dataType.simpleString()
    schema = f"chunk string, held boolean, ids {kind}, lengths array<long>, tokens binary, numbers binary, counts binary"
    return table.drop("words").join(answers, "chunk").mapInPandas(lambda frames: _each(frames, make), schema)


class _Grams:
    """A chunk's distinct trigrams, sorted by range and number, below their first two words.

    Every token ends one trigram; a further one after each text, of its last two tokens and no word, carries the count of that pair.
    ``of`` is each one's place among the distinct ones (-1: its first two words aren't known, so it has no count), ``pair_of`` its pair's.
    """

    def __init__(self, numbers: np.ndarray, local: np.ndarray, lengths: np.ndarray, ranges: int) -> None:
        known, rank = np.unique(np.concatenate([np.array([NONE, BEGIN], np.uint64), numbers]), return_inverse=True)
        width = len(known)
        tokens = rank[2:][local]
        last = np.cumsum(lengths) - 1
        first = last - lengths + 1
        before = np.full(len(tokens), 1)
        before[1:] = tokens[:-1]
        before[first] = 1
        earlier = np.full(len(tokens), 1)
        earlier[1:] = before[:-1]
        earlier[first] = 1
        x, y = np.concatenate([earlier, before[last]]), np.concatenate([before, tokens[last]])
        z = np.concatenate([tokens, np.zeros(len(last), tokens.dtype)])
        use = np.flatnonzero((x > 0) & (y > 0))
        pairs, pair_at = np.unique(x[use] * width + y[use], return_inverse=True)
        grams, at, self.n = np.unique(pair_at * width + z[use], return_inverse=True, return_counts=True)
        self.x, self.y, self.z = known[pairs // width], known[pairs % width], known[grams % width]
        owner = grams // width
        self.fan = np.bincount(owner, minlength=len(pairs))
        pair_range = _range(_mix(self.x, self.y), ranges)
        pair_order, order = np.argsort(pair_range, kind="stable"), np.argsort(pair_range[owner], kind="stable")
        self.pair_range, self.range = pair_range[pair_order], pair_range[owner][order]
        self.x, self.y, self.fan, self.z, self.n = self.x[pair_order], self.y[pair_order], self.fan[pair_order], self.z[order], self.n[order]
        self.of, self.pair_of = np.full(len(x), -1), np.full(len(x), -1)
        self.of[use], self.pair_of[use] = np.argsort(order)[at], np.argsort(pair_order)[pair_at]


def _gram_requests(table: DataFrame, ranges: int) -> DataFrame:
    """A message from each chunk to each range that it has pairs in: the pairs, how many trigrams each has, their last words, and counts."""

    def make(r) -> pd.DataFrame:
        g = _Grams(unpack(r.numbers, "<u8"), unpack(r.tokens, "<u4"), np.asarray(r.lengths), ranges)
        rows = []
        for (i, p), (_, t) in zip(_cuts(g.pair_range), _cuts(g.range), strict=True):
            steps = np.diff(g.x[p], prepend=np.uint64(0))
            rows.append([i, r.chunk, r.held, pack(steps, "<u8"), pack(g.y[p], "<u8"), pack(g.fan[p], "<u4"), pack(g.z[t], "<u8"), pack(g.n[t], "<u4")])
        return pd.DataFrame(rows, columns=["range", "chunk", "held", "x", "y", "fan", "z", "n"])

    schema = "range long, chunk string, held boolean, x binary, y binary, fan binary, z binary, n binary"
    return table.select("chunk", "held", "lengths", "tokens", "numbers").mapInPandas(lambda frames: _each(frames, make), schema)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """A number for each distinct combination of the keys."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _answer_grams(df: pd.DataFrame) -> pd.DataFrame:
    """Add up one range's training counts of pairs and trigrams, and answer every message."""
    read = lambda column, kind: [unpack(b, kind) for b in df[column]]
    x, y, fan, z, n = [np.cumsum(s, dtype=np.uint64) for s in read("x", "<u8")], read("y", "<u8"), read("fan", "<u4"), read("z", "<u8"), read("n", "<u4")
    training = ~df["held"].to_numpy(bool)
    pair = _groups(np.concatenate(x), np.concatenate(y))
    owner = np.repeat(pair, np.concatenate(fan))
    times = np.concatenate(n) * np.repeat(training, [len(k) for k in z])
    gram = _groups(owner, np.concatenate(z))
    pair_sums = np.bincount(owner, weights=times)[pair]
    sums = np.bincount(gram, weights=times)[gram]
    out = {"range": df["range"], "chunk": df["chunk"]}
    for name, values, parts in (("pairs", pair_sums, x), ("grams", sums, z)):
        out[name] = [pack(v, "<u8") for v in np.split(values, np.cumsum([len(p) for p in parts])[:-1])]
    return pd.DataFrame(out)


def _counted(table: DataFrame, replies: DataFrame, ranges: int) -> DataFrame:
    """``(held, ids, lengths, c1, c2, c3)``: the counts of each token's word, of the two words before each token (and of the two last after
    each text), and of its trigram."""

    def make(r) -> pd.DataFrame:
        local, lengths = unpack(r.tokens, "<u4"), np.asarray(r.lengths)
        g = _Grams(unpack(r.numbers, "<u8"), local, lengths, ranges)
        answers = sorted([] if r.answers is None else r.answers, key=lambda a: a["range"])
        found = []
        for side, keys, at in (("pairs", g.x, g.pair_of), ("grams", g.z, g.of)):
            values = np.concatenate([unpack(a[side], "<u8") for a in answers] or [np.zeros(0, np.uint64)])
            if len(values) != len(keys):
                raise ValueError(f"chunk {r.chunk} got {len(values)} answers for {len(keys)} {side}")
            found.append(np.append(values, np.uint64(0))[at])  # the last is for those without a count
        c1 = unpack(r.counts, "<u8")[local]
        row = [r.held, r.ids, r.lengths, pack(c1, "<u8"), pack(found[0], "<u8"), pack(found[1][: len(local)], "<u8")]
        return pd.DataFrame([row], columns=["held", "ids", "lengths", "c1", "c2", "c3"])

    answers = replies.groupBy("chunk").agg(F.collect_list(F.struct("range", "pairs", "grams")).alias("answers"))
    kind = table.schema["ids"].dataType.simpleString()
    schema = f"held boolean, ids {kind}, lengths array<long>, c1 binary, c2 binary, c3 binary"
    return table.join(answers, "chunk", "left").mapInPandas(lambda frames: _each(frames, make), schema)


class _Counts:
    """A chunk's counts for each token: ``w``, ``v`` (the word before), ``vw``, ``uv`` and ``uvw``; all lessened by ``less``."""

    def __init__(self, r, less: int = 0) -> None:
        lengths = np.asarray(r.lengths)
        n, last = int(lengths.sum()), np.cumsum(lengths) - 1
        first = last - lengths + 1
        self.w, both, self.uvw = (unpack(b, "<u8").astype(float) for b in (r.c1, r.c2, r.c3))
        self.v = np.roll(self.w, 1)
        self.v[first] = self.w[last]  # as many texts begin as end
        self.uv, self.vw = both[:n], np.roll(both[:n], -1)
        self.vw[last] = both[n:]
        if less:
            for name in ("w", "v", "vw", "uv", "uvw"):
                setattr(self, name, np.maximum(getattr(self, name) - less, 0))


def _weight(bins: np.ndarray, n: np.ndarray, scale: float = 1.0, rounds: int = 1000) -> float:
    """The share of the first component, by expectation-maximisation over counted likelihood ratios (first to second)."""
    if not n.sum():
        return 0.5
    ratio, share = _ratio(bins) * scale, 0.5
    for _ in range(rounds):
        new = float((n * (share * ratio / (share * ratio + 1 - share))).sum() / n.sum())
        new = min(max(new, 1e-6), 1 - 1e-6)
        if abs(new - share) < 1e-10:
            break
        share = new
    return share


def _bucket(c: np.ndarray) -> np.ndarray:
    """Frequency buckets of contexts: the bit length of the count."""
    return np.frexp(c)[1]


def _shares(rows: DataFrame) -> np.ndarray:
    """The weight of each bucket from ``(bucket, bin, n)``; a bucket without evidence takes that of the nearest one that has some."""
    got = {int(b): _weight(x["bin"].to_numpy(np.int64), x["n"].to_numpy(float)) for b, x in rows.toPandas().groupby("bucket")}
    nearest = [min(got, key=lambda g: (abs(g - b), g)) if got else None for b in range(66)]
    return np.array([0.5 if b is None else got[b] for b in nearest])


def _over(upper: np.ndarray, context: np.ndarray, share: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Interpolate a maximum-likelihood estimate with the model below it; a context that was never seen leaves it to that."""
    a = np.where(context > 0, share[_bucket(context)], 0.0)
    return a * upper / np.maximum(context, 1) + (1 - a) * lower


def _evidence(table: DataFrame, below: Callable[[_Counts], np.ndarray], upper: str, context: str) -> DataFrame:
    """``(bucket, bin, n)``: training tokens, each deleted from the counts, by context bucket and ratio of the estimate to the model below."""

    def make(r) -> pd.DataFrame:
        c = _Counts(r, less=1)
        ctx, up = getattr(c, context), getattr(c, upper)
        seen = ctx > 0
        code = _bucket(ctx[seen]).astype(np.int64) * 100_000 + _bins(up[seen] / ctx[seen] / below(c)[seen]) + 50_000
        found, n = np.unique(code, return_counts=True)
        return pd.DataFrame({"bucket": found // 100_000, "bin": found % 100_000 - 50_000, "n": n})

    rows = table.where("not held").select("lengths", "c1", "c2", "c3").mapInPandas(lambda frames: _each(frames, make), "bucket long, bin long, n long")
    return rows.groupBy("bucket", "bin").agg(F.sum("n").alias("n"))


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held: str = "crc32(coalesce(cast({id} as string), '')) % 7 = 2",
    chunk_tokens: int = CHUNK_TOKENS,
    range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per input row.

    ``held`` is a SQL predicate (``{id}`` stands for the id column) of the documents that the model doesn't learn from, neither counts nor
    weights. ``base_score`` is the add-one unigram score, ``score`` the interpolated model's log10 probability; both count the end of the
    text as a token. Null and empty texts are that one token. A null id counts as an empty one in the default predicate. Repeated rows count
    again; other columns are ignored; an empty table gives an empty result. Without training documents the model is uniform over one token.
    """
    table = materialize(chunks(docs, id_col, text_col, held.replace("{id}", f"`{id_col}`"), chunk_tokens), "chunks")
    asked, tokens = table.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    ranges = max(MIN_RANGES, -(-asked // range_keys))
    schema = "range long, chunk string, numbers binary, counts binary, total long, distinct long, bins array<long>, bin_n array<long>"
    replies = materialize(_word_requests(table, ranges).groupBy("range").applyInPandas(_answer_words(ranges), schema), "words")
    known = replies.where("chunk is null")
    total, distinct = known.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    level = known.select(F.explode(F.arrays_zip("bins", "bin_n")).alias("x")).groupBy("x.bins").agg(F.sum("x.bin_n").alias("n")).toPandas()
    uniform = 1 / (distinct + 1)
    m = _weight(level["bins"].to_numpy(np.int64), level["n"].to_numpy(float), scale=1 / max(total - 1, 1) / uniform) if total else 0.0
    numbered = materialize(_numbered(table, replies), "numbered")
    discard(table)
    discard(replies)

    ranges = max(MIN_RANGES, -(-tokens // range_keys))
    schema = "range long, chunk string, pairs binary, grams binary"
    replies = materialize(_gram_requests(numbered, ranges).groupBy("range").applyInPandas(_answer_grams, schema), "grams")
    counted = materialize(_counted(numbered, replies, ranges), "counted")
    discard(numbered)
    discard(replies)

    def single(c: _Counts, of: int) -> np.ndarray:
        return m * c.w / max(of, 1) + (1 - m) * uniform

    pair_share = _shares(_evidence(counted, lambda c: single(c, total - 1), "vw", "v"))
    gram_share = _shares(_evidence(counted, lambda c: _over(c.vw, c.v, pair_share, single(c, total - 1)), "uvw", "uv"))

    def make(r) -> pd.DataFrame:
        c, lengths = _Counts(r), np.asarray(r.lengths)
        p = _over(c.uvw, c.uv, gram_share, _over(c.vw, c.v, pair_share, single(c, total)))
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        base = np.log10((c.w + 1) / (total + distinct + 1))
        return pd.DataFrame(
            {
                "id": r.ids, "held_out": r.held, "n_tokens": lengths, "n_known": np.add.reduceat((c.w > 0).astype(np.int64), starts),
                "train_tokens": total, "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts),
            }
        )

    kind = counted.schema["ids"].dataType.elementType.simpleString()
    out = counted.mapInPandas(
        lambda frames: _each(frames, make), f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumnRenamed("id", id_col)
