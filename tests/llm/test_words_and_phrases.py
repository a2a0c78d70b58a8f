"""BPE with word ends, collocations and hard negatives against the public tokenizer and against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from turnlake.llm import negatives, phrases, queries, wordbpe

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def word_encoder():
    return wordbpe.WordEncoder(WORD_BPE)


ODD_TEXTS = [
    None, "", "  \t\n ", "Hello, world! It's 1234 o'clock", "<|endoftext|>a<|startoftext|> <|endof", "ΣΑΣ ΑΣ", "a" * 5000, "İI", "don't 'S's ''s", "\x1c\x1d\x85​﻿ x",
    "é é é ̴ͅ", "½² 日本語テスト ١٢٣", "aͅ࢏̴ Ɤ\U00010d50 ౜", "snow☃man 👩‍🔬", "x" * 300 + " " + "yz" * 200,
]


def test_word_bpe_equals_the_public_tokenizer(word_encoder):
    known = Tokenizer.from_file(WORD_BPE)
    rng = random.Random(7)
    syllables = ["the", "in", "ing", "an", "re", "er", "or", "s", "t", "a", "é", "'", "<|endoftext|>", "9"]
    texts = [x or "" for x in ODD_TEXTS] + ["".join(rng.choice(syllables) for _ in range(40)) for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(161, 0x3000), rng.randrange(0x10000, 0x20000)])) for _ in range(30)) for _ in range(300)]
    for text, ids in zip(texts, word_encoder.encode_all(texts), strict=True):
        expected = known.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert word_encoder.decode(ids) == known.decode(expected, skip_special_tokens=False)


def test_word_trie_computes_a_shared_prefix_once(word_encoder):
    words = ["walk", "walks", "walked", "walking", "walkers", "talk", "w"]
    trie = wordbpe.WordTrie(word_encoder.vocabulary, words)
    found = dict(trie.encodings())
    assert set(found) == set(words)
    ends = {(w[:-1], w[-1], "end") for w in words}
    inner = {w[:k] for w in words for k in range(1, len(w))}
    assert trie.states == len(ends) + len(inner) < sum(map(len, words))
    alone = {w: dict(wordbpe.WordTrie(word_encoder.vocabulary, [w]).encodings())[w] for w in words}
    assert alone == found


def test_word_bpe_of_long_texts_goes_by_portions(word_encoder, monkeypatch):
    text = "It's the quick brown fox's <|endoftext|> jump " * 300 + "z" * 900
    whole = list(word_encoder.encode_all([text, "ab c"]))
    monkeypatch.setattr(wordbpe, "PORTION", 100)
    assert list(word_encoder.encode_all([text, "ab c"])) == whole
    monkeypatch.setattr(wordbpe, "MEMORY_PIECES", 3)
    assert list(wordbpe.WordEncoder(WORD_BPE).encode_all([text, "ab c", text])) == [*whole, whole[0]]


def test_word_bpe_takes_linear_time(word_encoder):
    begin = time.perf_counter()
    list(word_encoder.encode_all(["ab" * 200_000, "é" * 100_000, "'s" * 200_000, "1" * 200_000]))
    assert time.perf_counter() - begin < 20


def test_word_bpe_frames(spark, tmp_path):
    rows = [(i, t, "en") for i, t in enumerate(ODD_TEXTS)] + [(None, "a b", None), (3, "again", "en"), (3, "again", "en")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit(1)).withColumn("id", F.lit(2))
    out = wordbpe.encode(docs, WORD_BPE, decoded=True)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    known, got = Tokenizer.from_file(WORD_BPE), out.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, set()).add(bytes(np.array(known.encode(t or "", add_special_tokens=False).ids, "<u4")))
    assert all(bytes(r.ids) in texts[r.doc_id] and r.n_tokens == len(r.ids) // 4 for r in got)
    back = wordbpe.decode(out.drop("decoded"), WORD_BPE).collect()
    assert Counter((r.doc_id, r.decoded) for r in back) == Counter((r.doc_id, r.decoded) for r in got)
    assert wordbpe.encode(docs.limit(0), WORD_BPE).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digest = queries.op12_word_bpe(spark, str(tmp_path)).where("doc_id = 4").first()
    ids = np.array(known.encode(ODD_TEXTS[4], add_special_tokens=False).ids, "<u4").tobytes()
    assert digest.ids_sha256 == hashlib.sha256(ids).hexdigest() and digest.n_tokens == len(ids) // 4
    assert digest.decoded_sha256 == hashlib.sha256(known.decode(known.encode(ODD_TEXTS[4], add_special_tokens=False).ids, skip_special_tokens=False).encode()).hexdigest()


def direct_phrases(rows, least, cover, top):
    f, totals = Counter(), Counter()
    for _, text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(w)
            f.update((lang or "und", *w[i : i + k]) for i in range(len(w)) for k in range(1, 4) if i + k <= len(w))
    f = Counter({p: n for p, n in f.items() if n >= least})
    out, longer = {}, {}
    for (lang, *w), n in f.items():
        for k in range(2) if len(w) == 3 else ():
            longer[lang, *w[k : k + 2]] = max(n, longer.get((lang, *w[k : k + 2]), 0))
    for (lang, *w), a in f.items():
        if len(w) > 1 and 100 * longer.get((lang, *w), 0) < cover * a:
            cuts = [(10**6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, x, y, totals[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])}


def phrase_rows(seed=3, docs=120):
    rng = random.Random(seed)
    words = ["The", "the", "of", "New", "york", "city", "é", "ÀB", "x|y", "nbsp in", *(f"w{i}" for i in range(40))]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "; "]) for _ in range(rng.randrange(150)))
    rows = [(i, text(), rng.choice(["en", "en", "de", None])) for i in range(docs)]
    return [*rows, (None, None, "en"), (1, "", None), (2, " \t\n", "fr"), *[(5, "hot word pair hot word pair x" * 30, "en")] * 3, (6, "one " * 3000 + ".\ttwo" * 12, "es")]


@pytest.mark.parametrize(("fan", "size"), [(1 << 10, 1 << 21), (1 << 10, 64), (3, 64)])
def test_phrase_counts_over_ranges_equal_direct_counts(spark, fan, size):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found, totals = phrases.counts(docs, fan=fan, range_suffixes=size, sample_every=7)
    direct, words = Counter(), Counter()
    for _, text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            direct.update((lang or "und", " ".join(w[i : i + k]), k) for i in range(len(w)) for k in range(1, 4) if i + k <= len(w))
    assert {(r.lang, r.phrase, r.k, r.n) for r in found.collect()} == {(*p, n) for p, n in direct.items() if n >= 10}
    assert {r.lang: r.n for r in totals.collect() if r.n} == {k: n for k, n in words.items() if n}


def test_collocations_equal_direct_ones(spark):
    rows = phrase_rows(11)
    docs = spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("x")).withColumn("k", F.lit(None).cast("int"))
    for top, cover in ((2000, 50), (5, 100), (2000, 10)):
        got = phrases.collocations(docs, top=top, cover=cover)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in got.collect()} == direct_phrases(rows, 10, cover, top)
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_quicksort_gives_partition_sizes_and_keeps_edges(monkeypatch):
    monkeypatch.setattr(phrases, "SMALL", 8)
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 6, (3, 4000))
    ids[0] += 1
    ids[2][ids[1] == 0] = 0
    ids, n = phrases._summed(ids, rng.integers(1, 4, 4000))
    none = (np.zeros(ids.shape[1], bool),) * 2
    found = {}
    for at, sizes, depth in phrases.quicksort(ids, n, 60, none):
        for p, size in zip(at.tolist(), sizes.tolist(), strict=True):
            assert found.setdefault(tuple(ids[:depth, p].tolist()), size) == size
    direct = Counter()
    for row, weight in zip(ids.T.tolist(), n.tolist(), strict=True):
        for depth in range(1, 4):
            if all(row[:depth]):
                direct[tuple(row[:depth])] += weight
    assert found == {p: size for p, size in direct.items() if size >= 60}
    edges = (ids[0] == 3, (ids[0] == 3) & (ids[1] == 2))
    extra = {tuple(ids[:d, p].tolist()) for at, _, d in phrases.quicksort(ids, n, 10**9, edges) for p in at.tolist()}
    assert extra == {(3,), (3, 2)}


def test_texts_are_read_in_bounded_windows(monkeypatch):
    data = b"aa bb. cc\tdd " * 50 + b"LONG" * 100 + b" e f"
    whole = [w for words, own in phrases._windows(data) for w in words[:own]]
    monkeypatch.setattr(phrases, "_SEGMENT", 16)
    seen = []
    for words, own in phrases._windows(data):
        assert words[own:] == whole[len(seen) + own :][: len(words) - own] and len(words) - own == min(2, len(whole) - len(seen) - own)
        seen += words[:own]
    assert seen == whole


VECTORS = "vec_id long, embedding array<float>, label int"


def direct_negatives(rows, positives=5, negatives_=3, low=50, high=95):
    """Over rows as (id, components, label): every anchor row against every other row."""
    usable = [(k, i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label) for k, (i, v, label) in enumerate(rows) if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    order = lambda hits: sorted(hits, key=lambda h: (-h[0], h[1] is None, h[1] or 0, h[2]))
    out = []
    for k, i, v, label in usable:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), j, m, other) for m, j, w, other in usable if m != k and len(w) == len(v)]
        for p in order([s for s in scored if s[3] == label])[:positives]:
            hits = order([s for s in scored if s[3] != label and low * p[0] <= 100 * s[0] <= high * p[0]])[:negatives_]
            out += [(i, p[1], rank + 1, s[1], p[0], s[0]) for rank, s in enumerate(hits)]
    return Counter(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(8)
    rows = [(i, [float(np.float32(x)) for x in centre * rng.choice([1, 1, 0.2, -1]) + rng.standard_normal(8) * 0.4], int(rng.integers(0, 3))) for i in range(400)]
    rows += [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [float("nan")] * 8, 1), (503, [float("inf")] * 8, 1), (550, [1.0] * 8, None), (600, [], 1), (601, [], 2)]
    rows += [(650, [0.5, 0.25], 0), (651, [0.5, 0.2], 0), (652, [0.4, 0.2], 1), (700, rows[50][1], rows[50][2]), (50, rows[50][1], rows[50][2]), (None, rows[3][1], 2), (None, rows[50][1], rows[50][2])]
    rows += [(750, [0.0] * 8, 1), (800, [-3.0e5] * 8, 2), (801, [-2.9e5] * 8, 2), (802, [-2.0e5] * 8, 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x")).withColumn("at", F.lit(0)).withColumn("id", F.lit("y")).repartition(3)
    expected = direct_negatives(rows)
    assert expected and any(r[1] is None or r[3] is None for r in expected) and any(r[4] > 2**32 for r in expected)
    got = negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.collect())) == expected
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 60)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 2)
    assert Counter(map(tuple, negatives.mine(df, F.col("vec_id") % 50 == 0, F.col("label")).collect())) == expected
    assert negatives.mine(df.limit(0), F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
    beyond = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.9], 2), (50, [1.0, 1.0], 1)], VECTORS)
    assert {(r.anchor_id, r.positive_id) for r in negatives.mine(beyond, F.col("vec_id") % 50 == 0, F.col("label")).collect()} == {(50, 1)}


@pytest.mark.parametrize("reach", [1, 300, 2**31, 2**32 - 1])
def test_packed_products_are_exact(reach):
    rng = np.random.default_rng(reach)
    for dims in (0, 1, 7, 64):
        limit = min(reach, int(3e9 / max(1, dims) ** 0.5))
        rows = rng.integers(-limit, limit + 1, (37, dims))
        for anchor in rng.integers(-limit, limit + 1, (3, dims)).tolist():
            assert negatives.PackedBlock(rows, reach).scores(anchor).tolist() == [sum(a * b for a, b in zip(anchor, r, strict=True)) for r in rows.tolist()]
    assert negatives.PackedBlock(np.zeros((0, 4), np.int64), reach).scores([1] * 4).tolist() == []
