"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece's bytes exactly one token can end its encoding: the token whose join with the encoding of what lies before
it survives the merge order. A table holds that last token for each prefix. Following it backwards gives the encoding; appending bytes
only adds entries; after an edit the entries before it stay, and recomputation stops as soon as a whole token length of entries agrees
with the old ones.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from turnlake.llm.arrow import text_slices, texts

#: Distinct pieces in each of the two generations of encodings that a Python worker remembers.
MEMORY_PIECES = 300_000


class Vocabulary:
    """Ranks (ids in merge order), the pair each token was last merged from, and which pairs may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=0)
        #: Every ending of a token, with its own rank or -1: a walk back from a prefix's end stops at the first miss.
        self.endings = {t[k:]: ranks.get(t[k:], -1) for t in ranks for k in range(len(t))}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(self.tokens))]
        self.joins: dict[tuple[int, int], int] = {}
        self._fits: dict[int, bool] = {}
        for rank, token in enumerate(self.tokens):
            for k in range(1, len(token or b"")):
                left, right = ranks.get(token[:k], rank), ranks.get(token[k:], rank)
                if left < rank and right < rank and self._check(left, right):
                    self.parts[rank] = left, right
                    self.joins[left, right] = rank
                    break

    def _check(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the border, latest first; an earlier merge across it would have broken the pair."""
        joins, parts = self.joins, self.parts
        bound = len(self.tokens)
        while True:
            if joins.get((left, right), bound) < bound:
                return False
            if left > right:
                bound, inner = left, parts[left][1]
                if inner != left:
                    left = inner
                    continue
                bound, inner = right + 1, parts[right][0]
                if inner == right:
                    return True
                right = inner
            else:
                bound, inner = right + 1, parts[right][0]
                if inner != right:
                    right = inner
                    continue
                bound, inner = left, parts[left][1]
                if inner == left:
                    return True
                left = inner

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their bytes."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= 1_000_000:
                self._fits.clear()
            known = self._fits[key] = self._check(left, right)
        return known

    def extend(self, data: bytes, last: list[int], end: int) -> None:
        """Append to ``last``, the entries before ``end``, the entry of the prefix ``data[:end]``."""
        endings, known = self.endings.get, self._fits.get
        for start in range(end - 1, -1, -1):
            rank = endings(data[start:end])
            if rank is None:
                break
            if rank >= 0:
                if not start:
                    return last.append(rank)
                ok = known(last[start - 1] << 32 | rank)
                if ok or ok is None and self.fits(last[start - 1], rank):
                    return last.append(rank)
        raise ValueError(f"the vocabulary has no token for the bytes before {end}")


class PrefixTable:
    """Bytes with the last token of each prefix's encoding. ``last[i]`` belongs to the first ``i + 1`` bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        begin = len(self.data)
        self.data += more
        for end in range(begin + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were computed anew."""
        old_last, moved = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old_last[:start]
        agreed = 0
        for end in range(start + 1, len(self.data) + 1):
            if agreed >= self.vocabulary.longest:
                self.last.extend(old_last[end - 1 - moved :])
                return end - 1 - start
            self.vocabulary.extend(self.data, self.last, end)
            agreed = agreed + 1 if end > start + len(new) and old_last[end - 1 - moved] == self.last[-1] else 0
        return len(self.data) - start

    def tokens(self) -> list[int]:
        out, end, lengths = [], len(self.data), self.vocabulary.tokens
        while end:
            out.append(self.last[end - 1])
            end -= len(lengths[out[-1]])
        return out[::-1]


class Encoder(dict):
    """Remembers pieces: a text piece's ids as bytes, found in the prefix table of its UTF-8 when first seen.

    Two generations: when the younger is full it becomes the older, and pieces used again move back.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        super().__init__()
        self.vocabulary, self.find, self.older = vocabulary, regex.compile(pattern).findall, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            found = [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()
            ids = np.array(found, "<u4").tobytes()
            if len(piece) > 64:
                return ids
        if len(self) >= MEMORY_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker: tasks that run in it later find the tables built."""
    return Encoder(Vocabulary(read_ranks(path)), pattern)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Encode whole texts: ``(id, n_tokens, ids)`` and, on request, ``decoded``, the bytes the ids stand for.

    ``ids`` holds the ids as little-endian unsigned 32-bit integers, as token files do. ``ranks_path`` is a file of ranks that every
    executor has installed. Null and empty texts have no tokens and empty bytes; texts of any length are encoded whole; null ids and
    repeated rows stay; other columns are ignored; an empty table gives an empty result.
    """
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids", "decoded"][: 3 + decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks_path, pattern)
        for batch in text_slices(batches, 1):
            n, ids, raw = [], [], []
            for text in texts(batch, 1):
                found = e.encode(text)
                n.append(len(found) // 4)
                ids.append(found)
                if decoded:
                    raw.append(e.decode(found))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    schema = f"id {kind}, n_tokens long, ids binary" + ", decoded binary" * decoded
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Turn ids (as :func:`encode` gives them) back into bytes: ``(id, decoded)``. Null ids give empty bytes."""
    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks_path, pattern)
        for batch in text_slices(batches, 1):
            raw = [e.decode(x.as_py() or b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["id", "decoded"])

    return source.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)
