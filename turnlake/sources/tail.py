"""Archives that grow, as a data source: lines with the number they have in their file, in batch and as a stream.

``file`` is the path below the folder and ``frame_seq`` the line's number from zero, so ``(file, frame_seq)`` is the same on every read, whatever
batch a line is in. A stream's offset is how many bytes of each file have been read. A batch reads a file up to the size that it had when the
batch was planned, and gives the lines that are whole by then and weren't before: a cut tail waits for its rest, and a batch that is tried again
gives the same rows. Gzip files may have several members; a last one that is cut gives what can be decoded.

A file's lines can only be numbered from its start: every batch that a file grows in reads it from there. Files are of an hour, so this is bounded
by the batches of an hour. One task reads one file and holds a block and a line.
"""

from __future__ import annotations

import fnmatch
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "turnlake_tail"
LINES = "file string, frame_seq long, raw string"
TAILS = "file string, lines long, cut long, damaged boolean"
_BLOCK = 1 << 20


def _open(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (arrow_fs.LocalFileSystem(), path)


def _listing(folder: str, names: str) -> dict[str, int]:
    """The size of each file below a folder whose name fits; none where there is no folder."""
    fs, base = _open(folder)
    base = base.rstrip("/")
    found = fs.get_file_info(arrow_fs.FileSelector(base, recursive=True, allow_not_found=True))
    return {f.path[len(base) + 1 :]: f.size for f in found if f.type == arrow_fs.FileType.File and fnmatch.fnmatch(f.base_name, names) and not f.base_name.startswith((".", "_"))}


class Damaged(Exception):
    """Bytes that no gzip member has."""


def _inflated(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """What the members say, in pieces of bounded size."""
    member = None
    for block in blocks:
        while block:
            member = member or zlib.decompressobj(wbits=31)
            try:
                piece = member.decompress(block, 4 * _BLOCK)
            except zlib.error as e:
                raise Damaged from e
            yield piece
            while not member.eof and member.unconsumed_tail:
                try:
                    piece = member.decompress(member.unconsumed_tail, 4 * _BLOCK)
                except zlib.error as e:
                    raise Damaged from e
                yield piece
            block, member = (member.unused_data, None) if member.eof else (b"", member)


@dataclass
class Part(InputPartition):
    """Bytes ``begin`` to ``end`` of a file, as it lies on disk."""

    file: str
    begin: int
    end: int


class _Numbered:
    """The lines of a file's first bytes, numbered; ``line`` is how many are whole, ``tail`` the pieces of what follows them."""

    def __init__(self, folder: str, file: str):
        self.folder, self.file, self.line, self.tail, self.damaged = folder, file, 0, [], False

    def _blocks(self, begin: int, end: int, source) -> Iterator[bytes]:
        while begin < end and (block := source.read(min(_BLOCK, end - begin))):
            begin += len(block)
            yield block

    def read(self, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
        """Lines that are whole within ``end`` bytes and weren't within ``begin``."""
        fs, base = _open(self.folder)
        with fs.open_input_stream(f"{base.rstrip('/')}/{self.file}", compression=None) as source:
            done = 0

            def counted() -> Iterator[bytes]:
                nonlocal done
                for stop in (begin, end):  # a block never goes across: what was whole before is known by its bytes alone
                    for block in self._blocks(done, stop, source):
                        done += len(block)
                        yield block

            pieces = counted()
            try:
                for piece in _inflated(pieces) if self.file.endswith(".gz") else pieces:
                    *whole, rest = piece.split(b"\n")
                    if whole:
                        whole[0], self.tail = b"".join([*self.tail, whole[0]]), []
                    self.tail.append(rest)
                    for line in whole:
                        if done > begin:
                            yield self.line, line
                        self.line += 1
            except Damaged:
                self.damaged = True


class _Files:
    def __init__(self, options: dict[str, str]):
        self.folder, self.names, self.tails = options["path"], options.get("names", "*.jsonl.gz"), options.get("tails") == "true"

    def read(self, part: Part) -> Iterator[tuple]:
        lines = _Numbered(self.folder, part.file)
        for n, raw in lines.read(part.begin, part.end):
            if not self.tails:
                yield part.file, n, raw.removesuffix(b"\r").decode("utf-8", "replace")
        if self.tails:
            yield part.file, lines.line, sum(map(len, lines.tail)), lines.damaged


class Batch(_Files, DataSourceReader):
    def partitions(self) -> Sequence[Part]:
        return [Part(f, 0, n) for f, n in sorted(_listing(self.folder, self.names).items())] or [Part("", 0, 0)]

    def read(self, part: Part) -> Iterator[tuple]:
        return super().read(part) if part.file else iter(())


class Stream(_Files, DataSourceStreamReader):
    """Offsets are ``{file: bytes}`` of the files that are there, so retention of archives bounds them too."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return _listing(self.folder, self.names)

    def partitions(self, start: dict, end: dict) -> Sequence[Part]:
        parts = []
        for file, size in sorted(end.items()):
            begin = start.get(file, 0)
            if size < begin:
                raise ValueError(f"{file} has {size} bytes, after {begin} were read: archives only grow")
            if size > begin:
                parts.append(Part(file, begin, size))
        return parts


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return TAILS if self.options.get("tails") == "true" else LINES

    def reader(self, schema) -> DataSourceReader:
        return Batch(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Stream(dict(self.options))


def read(spark: SparkSession, folder: str, names: str = "*.jsonl.gz") -> DataFrame:
    """``(file, frame_seq, raw)`` of the whole lines of all archives below a folder. Lines end with a line feed; invalid UTF-8 is replaced."""
    spark.dataSource.register(Tail)
    return spark.read.format(NAME).option("names", names).load(folder)


def tails(spark: SparkSession, folder: str, names: str = "*.jsonl.gz") -> DataFrame:
    """``(file, lines, cut, damaged)``: whole lines of each archive, bytes after the last of them, and whether a member can't be decoded. What
    follows damage isn't read, here or by a stream."""
    spark.dataSource.register(Tail)
    return spark.read.format(NAME).option("names", names).option("tails", "true").load(folder)


def stream(spark: SparkSession, folder: str, names: str = "*.jsonl.gz") -> DataFrame:
    """:func:`read` of archives as they grow and appear. A file that disappears has been read; one that shrinks stops the stream."""
    spark.dataSource.register(Tail)
    return spark.readStream.format(NAME).option("names", names).load(folder)
