"""BPE with word ends, by a traversal of a trie of words.

The distinct words of a slice of texts go into a trie, so that words with a common beginning share its nodes. A depth-first walk carries the
last token of every prefix on its path: of the tokens that end a prefix exactly one survives the merge order beside the token before it
(as in :mod:`turnlake.llm.bpe`). A node's state is thus computed once, however many words pass through it, and a word's encoding is read
off the path at its end. A word's last symbol differs from the same symbol inside a word, so every word ends in a leaf of its own.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from turnlake.llm.arrow import text_slices, texts
from turnlake.llm.bpe import MEMORY_PIECES, Vocabulary

#: Characters of a text whose words are held at once; longer texts are cut at spaces, where no word goes on.
PORTION = 1 << 22
#: Added to a byte for the symbol that it is at a word's end.
FINAL = 256


class WordVocabulary(Vocabulary):
    """Symbols and merges by number: bytes inside a word (their values) and at its end (plus :data:`FINAL`), then the tokens in merge order."""

    def __init__(self, model: dict) -> None:
        end, ids = model["end_of_word_suffix"] or "", model["vocab"]
        if not end or model["continuing_subword_prefix"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("a vocabulary with word ends and plain merges is needed")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = ["".join(m) for m in merges]
        letters = _byte_letters()
        names = [*letters, *(c + end for c in letters), *made]
        number = {name: k for k, name in enumerate(names)}
        if len(number) < len(names) or any(name not in ids for name in names):
            raise ValueError("every token needs one merge, and every byte a form inside and at the end of a word")
        self.tokens = names
        self.packed = [ids[name].to_bytes(4, "little") for name in names]
        self.joins = {(number[a], number[b]): number[ab] for (a, b), ab in zip(merges, made, strict=True)}
        self.parts = [(k, k) for k in range(2 * FINAL)] + list(self.joins)
        self._fits: dict[int, bool] = {}
        # Tokens read from their ends: a state for each ending of a token, and the token that it is, or -1.
        self._back: dict[int, int] = {}
        self._ends = [-1]
        spelled: list[tuple[int, ...]] = []
        self.lengths: list[int] = []
        for k, (left, right) in enumerate(self.parts):
            spelled.append((k,) if left == k else spelled[left] + spelled[right])
            self.lengths.append(len(spelled[k]))
            state = 0
            for symbol in reversed(spelled[k]):
                state = self._back.setdefault(state * 2 * FINAL + symbol, len(self._ends))
                if state == len(self._ends):
                    self._ends.append(-1)
            self._ends[state] = k

    def last_token(self, path: list[int], last: list[int]) -> int:
        """The token that ends the encoding of ``path``, when ``last`` holds those of its shorter prefixes."""
        back, ends, known = self._back.get, self._ends, self._fits.get
        state, at = 0, len(path)
        while at:
            at -= 1
            state = back(state * 2 * FINAL + path[at])
            if state is None:
                break
            token = ends[state]
            if token >= 0:
                if not at:
                    return token
                ok = known(last[at - 1] << 32 | token)
                if ok or ok is None and self.fits(last[at - 1], token):
                    return token
        raise ValueError("no token ends this prefix")


@functools.cache
def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class WordTrie:
    """Words by their bytes: a node is a dict from symbol to node, and where only one word is left, to that word."""

    def __init__(self, vocabulary: WordVocabulary, words: Iterable[str]) -> None:
        self.vocabulary, self.root, self.states = vocabulary, {}, 0
        for word in words:
            self._insert(word, word.encode())

    def _insert(self, word: str, symbols: bytes) -> None:
        node, at, end = self.root, 0, len(symbols) - 1
        while at < end:
            below = node.get(symbols[at])
            if below is None:
                node[symbols[at]] = word
                return
            at += 1
            if isinstance(below, str):  # no longer alone: it moves one node down
                other = below.encode()
                node[other[at - 1]] = {other[at] + (FINAL if at + 1 == len(other) else 0): below}
                below = node[other[at - 1]]
            node = below
        node[symbols[end] + FINAL] = word

    def encodings(self) -> Iterator[tuple[str, bytes]]:
        """Every word with the ids of its tokens, in one depth-first walk; ``states`` counts the prefixes it computed."""
        last_token, lengths, packed = self.vocabulary.last_token, self.vocabulary.lengths, self.vocabulary.packed
        path, last, open_nodes = [], [], [iter(self.root.items())]
        while open_nodes:
            for symbol, below in open_nodes[-1]:
                path.append(symbol)
                last.append(last_token(path, last))
                if isinstance(below, dict):
                    open_nodes.append(iter(below.items()))
                    break
                depth = len(path)
                if symbol < FINAL:  # the rest of a word that is alone
                    rest = list(below.encode()[depth:])
                    rest[-1] += FINAL
                    for symbol in rest:
                        path.append(symbol)
                        last.append(last_token(path, last))
                found, at = [], len(path)
                self.states += at - depth + 1
                while at:
                    token = last[at - 1]
                    found.append(packed[token])
                    at -= lengths[token]
                found.reverse()
                yield below, b"".join(found)
                del path[depth - 1 :], last[depth - 1 :]
            else:
                open_nodes.pop()
                if open_nodes:
                    self.states += 1
                    path.pop()
                    last.pop()


class Words:
    """How a tokenizer file splits texts: at its special tokens, then normalised, then by its pattern.

    The pattern and the normalisation are applied with Python's tables. Unicode versions differ in what the newest characters are, so each
    character is first tried on the file's own normaliser and splitter; a text with one that they treat otherwise is split by them.
    """

    def __init__(self, tokenizer: Tokenizer) -> None:
        told = json.loads(tokenizer.to_str())
        steps = [s["type"] for s in told["normalizer"]["normalizers"]], [s["type"] for s in told["pre_tokenizer"]["pretokenizers"]]
        split = told["pre_tokenizer"]["pretokenizers"][0]
        if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or not split["invert"] or told["added_tokens"] and any(
            t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]
        ):
            raise ValueError("texts of this tokenizer file are split in a way that isn't known here")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self._cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._normalizer, self._splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self._known, self._odd = set(map(chr, range(128))), set()

    @staticmethod
    def normalise(text: str) -> str:
        """Composed and in lower case, character by character (a sigma at a word's end is no exception); white space is left alone."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _agrees(self, c: str) -> bool:
        probes = f"b{c}a", f"bͅ{c}̴a"
        spans = [self._splitter.pre_tokenize_str(x) for x in (f"a{c}!", f"1{c}!")]
        own = [self.find(x) for x in (f"a{c}!", f"1{c}!")]
        theirs = [[x[a:b] for _, (a, b) in s] for x, s in zip((f"a{c}!", f"1{c}!"), spans, strict=True)]
        return own == theirs and (c.isspace() or all(self.normalise(x) == self._normalizer.normalize_str(x) for x in probes))

    def _plain(self, text: str) -> bool:
        if text.isascii():
            return True
        seen = set(text)
        for c in seen - self._known - self._odd:
            (self._known if self._agrees(c) else self._odd).add(c)
        return self._odd.isdisjoint(seen)

    def pieces(self, text: str) -> Iterator[list[str] | int]:
        """The text's words in lists, in order, and the ids of special tokens between them."""
        for k, part in enumerate(self._cut.split(text) if self._cut else [text]):
            if k % 2:
                yield self.special[part]
                continue
            plain = self._plain(part)
            part = self.normalise(part) if plain else self._normalizer.normalize_str(part)
            start = 0
            while start < len(part):
                stop = start + PORTION
                if stop < len(part):  # at the last space, or else at the next
                    stop = max(part.rfind(" ", start, stop), 0) or part.find(" ", stop)
                    stop = len(part) if stop < 0 else stop + 1
                portion = part[start:stop]
                yield self.find(portion) if plain else [portion[a:b] for _, (a, b) in self._splitter.pre_tokenize_str(portion)]
                start = stop


class WordEncoder:
    """Remembers words in two generations: when the younger is full it becomes the older, and words used again move back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.vocabulary = WordVocabulary(told["model"])
        self.words = Words(Tokenizer.from_file(path))
        self.names = {i: name for name, i in told["model"]["vocab"].items()} | {i: name for name, i in self.words.special.items()}
        self.younger: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Afterwards all of ``words`` are remembered."""
        new = words - self.younger.keys()
        if len(self.younger) + len(new) > MEMORY_PIECES:
            self.older, self.younger, new = self.younger, {}, words
        again = new & self.older.keys()
        self.younger.update((w, self.older[w]) for w in again)
        self.younger.update(WordTrie(self.vocabulary, new - again).encodings())

    def encode_all(self, slice_of_texts: Iterable[str]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. The words of several texts share a trie."""
        waiting: list[list[list[str] | int]] = []
        size = 0
        for text in slice_of_texts:
            if len(text) > PORTION:  # portion by portion
                yield from self._finish(waiting)
                waiting, size = [], 0
                yield b"".join(x for p in self.words.pieces(text) for x in self._finish([[p]]))
                continue
            waiting.append(list(self.words.pieces(text)))
            size += len(text)
            if size > PORTION:
                yield from self._finish(waiting)
                waiting, size = [], 0
        yield from self._finish(waiting)

    def _finish(self, waiting: list[list[list[str] | int]]) -> Iterator[bytes]:
        self.learn(set().union(*(p for pieces in waiting for p in pieces if not isinstance(p, int))))
        known = self.younger.__getitem__
        for pieces in waiting:
            yield b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(known, p)) for p in pieces)

    def decode(self, ids: bytes) -> str:
        """The tokens' names with spaces between them: the file has no decoder that would put them together."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker: tasks that run in it later find the tables built."""
    return WordEncoder(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Encode whole texts with a tokenizer file: ``(id, n_tokens, ids)`` and, on request, ``decoded``, the ids as text again.

    ``path`` is a file that every executor has installed. Texts are split at the file's special tokens, composed, put in lower case and split
    into words; white space is dropped. ``ids`` holds the ids as little-endian unsigned 32-bit integers. Null and empty texts, and those of
    white space, have no tokens and an empty ``decoded``; texts of any length are encoded whole; null ids and repeated rows stay; other
    columns are ignored, whatever their names; an empty table gives an empty result.
    """
    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    names = ["id", "n_tokens", "ids", "decoded"][: 3 + decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in text_slices(batches, 1):
            ids = list(e.encode_all(texts(batch, 1)))
            n = pa.array([len(x) // 4 for x in ids], pa.int64())
            back = pa.array(map(e.decode, ids) if decoded else [None] * len(ids), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(ids, pa.binary()), back][: len(names)], names)

    schema = f"id {kind}, n_tokens long, ids binary" + ", decoded string" * decoded
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Turn ids (as :func:`encode` gives them) back into text: ``(id, decoded)``. Null ids give an empty text."""
    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in text_slices(batches, 1):
            back = pa.array((e.decode(x.as_py() or b"") for x in batch.column(1)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), back], ["id", "decoded"])

    return source.mapInArrow(run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)
