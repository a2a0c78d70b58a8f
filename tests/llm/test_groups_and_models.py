"""Near-duplicates, components, mixing, language model and quality classifier against brute force, and their edge cases."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from turnlake.llm import lm, mixing, quality, simhash, vectors
from turnlake.llm.components import connected_components


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(500, k) for k in range(501, 540)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = union_find({x for p in pairs for x in p}, pairs)
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in pairs)}
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        text = " ".join(rnd.choice(["A", "the", "É", "wörld", "x", "\x0b", "日本"]) for _ in range(rnd.randint(0, 40)))
        assert simhash.fingerprint(text) == brute_print(text)


def test_links_connect_what_all_pairs_connect(spark):
    rnd = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(40):
        base = rnd.getrandbits(64)
        prints |= {base ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 5))) & (2**64 - 1) for _ in range(12)}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    found = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()]
    assert pairs and union_find(signed, found) == union_find(signed, pairs)


@pytest.mark.parametrize("block_rows", [1, 5, 1000])
def test_crowded_buckets_are_split_and_lose_nothing(spark, block_rows):
    rnd = random.Random(5)
    prints = {0x5555 << 32 | rnd.getrandbits(12) for _ in range(120)} | {0x5557 << 32 | rnd.getrandbits(12) for _ in range(60)} | {rnd.getrandbits(62) for _ in range(50)}
    pairs = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3]
    found = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), block_rows=block_rows).collect()]
    assert union_find(prints, found) == union_find(prints, pairs)


def test_simhash_groups_and_edge_cases(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, 1), (3, text.upper(), 1), (9, None, 1), (8, "", 1), (7, "other words entirely in this text", 1), (None, text, 1), (None, "lonely text", 1), (5, text, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert got == Counter([(5, 3), (5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, 3), (None, None)])
    assert simhash.near_duplicates(df.where("false")).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 16))
    data = np.concatenate([c + 0.05 * rng.standard_normal((8, 16)) for c in centres] + [rng.standard_normal((200, 16))]).astype("float32")
    labels = [int(x) if x < 3 else None for x in rng.integers(0, 4, len(data))]
    rows = [(i, v.tolist(), y, 0) for i, (v, y) in enumerate(zip(data, labels, strict=True))]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, data[0].tolist()[:8]]
    rows += [(n + i, v, 0, 0) for i, v in enumerate(odd)] + [(n + 10, data[1].tolist(), labels[1], 0), (n + 11, data[1].tolist(), labels[1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n int")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    ids = [i for i, (k, v, y, _) in enumerate(rows) if y is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i][1] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([rows[i][2] for i in ids])
    hit = (x @ x.T >= 0.98) & (y[:, None] == y)
    np.fill_diagonal(hit, False)
    keys = [rows[i][0] for i in ids]
    want = union_find(keys, [(keys[a], keys[b]) for a, b in zip(*np.nonzero(hit), strict=True)])
    assert hit.sum() > 100
    found = sum(got[k]["n_links"] for k in keys)
    assert found <= hit.sum() and found >= 0.98 * hit.sum()
    assert np.mean([got[k]["component_id"] == want[k] for k in keys]) > 0.98
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all(got[r[0]]["n_links"] == 0 and got[r[0]]["kept"] for r in rows if r[0] not in want)
    assert vectors.near_duplicates(df.where("false")).count() == 0


def test_vectors_of_any_length_are_compared_by_angle(spark):
    far, near = [1.0, 0.0, 0.0, 0.0], [1.0, 0.02, 0.0, 0.0]
    rows = [(i, [x * scale for x in v]) for i, (v, scale) in enumerate((v, s) for s in (1.0, 1e-200, 1e-310, 1e200) for v in (far, near, [0.02, 1.0, 0.0, 0.0]))]
    got = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")).collect()}
    assert all(r["n_links"] == (3 if i % 3 == 2 else 7) and r["component_id"] == (2 if i % 3 == 2 else 0) for i, r in got.items())


def test_labels_of_very_different_sizes_have_grids_of_their_own(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((500, 12))
    crowd = np.concatenate([centres + 0.05 * rng.standard_normal(centres.shape) for _ in range(6)])
    data = np.concatenate([crowd, rng.standard_normal((300, 12))])
    labels = [0] * len(crowd) + [1 + i // 2 for i in range(300)]
    df = spark.createDataFrame([(i, v.tolist(), y) for i, (v, y) in enumerate(zip(data, labels, strict=True))], "vec_id long, embedding array<double>, label int")
    x = data / np.linalg.norm(data, axis=1, keepdims=True)
    hit = (x @ x.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels))
    np.fill_diagonal(hit, False)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df).collect()}
    assert hit.sum() > 1000 and all(got[i] <= hit[i].sum() for i in got)
    assert sum(got.values()) >= 0.98 * hit.sum()


def test_the_walk_visits_cells_by_their_sum_and_stops():
    rng = np.random.default_rng(7)
    a, b = np.sort(rng.random(30)), np.sort(rng.random(20))
    a[0] = b[0] = 0
    names = rng.permutation(30), rng.permutation(20)
    got = list(vectors._walk((a.tolist(), b.tolist()), names, 0.6))
    cost = {(int(names[0][i]), int(names[1][j])): a[i] + b[j] for i in range(30) for j in range(20)}
    assert set(got) == {k for k, c in cost.items() if c <= 0.6} and [cost[k] for k in got] == sorted(cost[k] for k in got)


def direct_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    left, out = share * sum(sizes), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in out]
        total = sum(weights[i % len(weights)] for i in rest)
        over = [i for i in rest if left * weights[i % len(weights)] / total > cap * sizes[i]]
        if not over:
            return [out.get(i, left * weights[i % len(weights)] / total if total else 0.0) for i in range(len(sizes))]
        for i in over:
            out[i] = cap * sizes[i]
        left = share * sum(sizes) - sum(out.values())


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000], [0, 0], [], [5], [1, 10, 100, 1000, 10_000, 3, 77, 0, 50_000]])
def test_targets_reshare_what_caps_leave(spark, sizes):
    df = spark.createDataFrame(list(enumerate(sizes)), "index long, size long")
    got = [r["target"] for r in mixing.targets(df, (3, 1, 2), 1.5, 2.0).orderBy("index").collect()]
    assert got == pytest.approx(direct_targets(sizes))


def test_many_sources_share_a_schedule(spark):
    rows = [(i, "w " * (5 + i % 9), f"s{i % 3000}") for i in range(9000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=8)
    got = out.taken().groupBy("source", "source_size", "target").agg({"taken": "sum"}).collect()
    want = direct_targets([r["source_size"] for r in sorted(got, key=lambda r: r["source"])])
    assert [r["target"] for r in sorted(got, key=lambda r: r["source"])] == pytest.approx(want)
    assert len(got) == 3000 and max(abs(r["sum(taken)"] - r["target"]) for r in got) <= 8 * 2
    slots = [r["slot"] for r in out.pieces.select("slot").distinct().orderBy("slot").collect()]
    assert slots[:100] == list(range(100))


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(6)
    rows = [(i if i % 50 else None, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 900])) if i % 11 else None, rnd.choice(["a", "b", "B", None]), "x") for i in range(400)]
    rows += rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    runs = [sorted(map(tuple, mixing.mix(df).taken().select("id", "source", "size", "source_size", "target", "taken").collect()), key=str) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, direct_targets([sizes[s] for s in order]), strict=True))
    taken = Counter()
    for _, source, size, source_size, target, n in runs[0]:
        assert source_size == sizes[source] and target == want[source] and 0 <= n <= 2 * size
        taken[source] += n
    assert all(abs(taken[s] - want[s]) <= 256 for s in order)
    assert mixing.mix(df.where("false")).taken().count() == 0
    assert {r["taken"] for r in mixing.mix(df.where("text is null")).taken().collect()} == {0}


def test_slots_name_each_word_once(spark):
    df = spark.createDataFrame([(i, "w " * (i * 7 % 90 + 1), f"s{i % 3}") for i in range(120)], "doc_id long, text string, source string")
    plan = mixing.mix(df, block_words=32)
    pieces = plan.pieces.collect()
    slots = Counter()
    for p in pieces:
        slots[p["slot"]] += p["to"] - p["from"]
    assert max(slots.values()) <= 32 and sorted(slots)[: len(slots) // 2] == list(range(len(slots) // 2))
    spans = sorted((p["src"], p["start"], p["epoch"], p["from"], p["to"]) for p in pieces)
    assert all(a[:3] != b[:3] or a[4] == b[3] for a, b in zip(spans, spans[1:]))


VOCABULARY = ["the", "The", "of", "a", "b", "c", "é", "zz"]


def lm_rows(seed=7, n=150):
    rnd = random.Random(seed)
    rows = [(i if i else None, " ".join(rnd.choice(VOCABULARY) for _ in range(rnd.randint(0, 30))) if i % 13 else None) for i in range(n)]
    return rows + [(n + k, "the of a b c zz of the") for k in range(6)]


def lm_tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def direct_lm(rows):
    """Every document's (base_score, score) by direct counts, and direct expectation-maximisation over deleted tokens."""
    tokens = [lm_tokens(t) for _, t in rows]
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    one, two, three, before, pair_before = Counter(), Counter(), Counter(), Counter(), Counter()
    events = []
    for ws, h in zip(tokens, held):
        padded = ["<s>", "<s>", *ws]
        for u, v, w in zip(padded, padded[1:], ws):
            if not h:
                one[w] += 1
                two[v, w] += 1
                three[u, v, w] += 1
                before[v] += 1
                pair_before[u, v] += 1
                events.append((u, v, w))
    n, size = sum(one.values()), len(one)

    def share(ratios):
        s = 0.5
        for _ in range(500):
            s = min(max(sum(s * r / (s * r + 1 - s) for r in ratios) / len(ratios), 1e-6), 1 - 1e-6)
        return s

    m = share([(one[w] - 1) / (n - 1) * (size + 1) for _, _, w in events])
    p1 = lambda w, d: m * (one[w] - d) / (n - d) + (1 - m) / (size + 1)

    def fit(top, context, lower):
        by = {}
        for e in events:
            if context(e) > 1:
                by.setdefault((context(e) - 1).bit_length(), []).append((top(e) - 1) / (context(e) - 1) / lower(e, 1))
        got = {b: share(r) for b, r in by.items()}
        return lambda c: got[min(got, key=lambda g: (abs(g - c.bit_length()), g))]

    def level(top, context, lower, weight):
        def p(e, d):
            c = context(e) - d
            return weight(c) * (top(e) - d) / c + (1 - weight(c)) * lower(e, d) if c > 0 else lower(e, d)

        return p

    low = lambda e, d: p1(e[2], d)
    pair = (lambda e: two[e[1:]], lambda e: before[e[1]], low)
    mid = level(*pair, fit(*pair))
    gram = (lambda e: three[e], lambda e: pair_before[e[:2]], mid)
    high = level(*gram, fit(*gram))
    out = []
    for ws in tokens:
        padded = ["<s>", "<s>", *ws]
        base = sum(math.log10((one[w] + 1) / (n + size + 1)) for w in ws)
        out.append((len(ws), sum(one[w] > 0 for w in ws), n, base, sum(math.log10(high(e, 0)) for e in zip(padded, padded[1:], ws))))
    return held, out


@pytest.mark.parametrize("sizes", [{}, {"chunk_tokens": 40, "range_keys": 20}])  # one chunk a task; several, and ranges that split the keys
def test_lm_equals_direct_counts(spark, sizes):
    rows = lm_rows()
    schema = "doc_id long, text string, held boolean, chunk int"
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame([(*r, True, 1) for r in rows], schema), **sizes).collect()}
    held, want = direct_lm(rows)
    assert len(got) == len(rows)
    for (i, _), h, (n_tokens, n_known, total, base, score) in zip(rows, held, want):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, n_tokens, n_known, total)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(score, rel=0.01)  # likelihood ratios are binned
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lm_learns_nothing_from_held_out_documents(spark):
    rows = lm_rows(8, 60)
    held, _ = direct_lm(rows)
    scores = []
    for text in (None, "the the the the", "unseen words " * 50):
        changed = [(i, text if h else t) for (i, t), h in zip(rows, held)]
        got = lm.score(spark.createDataFrame(changed, "doc_id long, text string")).where("not held_out")
        scores.append({r["doc_id"]: (r["score"], r["base_score"]) for r in got.collect()})
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == held.count(False)


def test_lm_is_a_distribution(spark):
    rows = [(i, f"a b {'a b ' * (i % 3)}b") for i in range(40)]
    held = [i for i in range(2000, 3000) if zlib.crc32(str(i).encode()) % 7 == 2]
    # the chance of a text is that of its words after each other and then the end: over all texts of at most one word, and two-word starts
    texts = ["", *[" ".join(t) for n in (1, 2, 3) for t in itertools.product(["a", "b", "zzz"], repeat=n)]]
    got = {r["doc_id"]: 10 ** r["score"] for r in lm.score(spark.createDataFrame(rows + list(zip(held, texts)), "doc_id long, text string")).collect()}
    chance = {t: got[i] for i, t in zip(held, texts)}
    assert 0.5 < sum(chance.values()) < 1  # distinct texts, of one unknown word only
    assert chance["a b b"] > 100 * chance["b a a"]


def test_lm_without_training_documents(spark):
    i = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = lm.score(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_em_finds_the_share():
    rng = np.random.default_rng(0)
    first = rng.random(20_000) < 0.7
    ratio = np.where(first, 4.0, 0.25)  # P1 is 0.8 and 0.2, P2 is 0.2 and 0.8 when the share is 0.7 of the first
    bins, n = np.unique(lm._bins(np.where(rng.random(20_000) < np.where(first, 0.8, 0.2), 4.0, 0.25)), return_counts=True)
    assert lm._weight(bins, n) == pytest.approx(0.7, abs=0.02) and ratio.size


def test_classifier_learns_and_shrinks(spark):
    rnd = random.Random(8)
    good, bad, toxic = ["river", "garden", "letter", "window", "market"], ["%%%", "$$$", "buy***", "###"], ["idiot", "moron"]
    docs, labels = [], []
    for i in range(600):
        q, t = rnd.random() < 0.7, rnd.random() < 0.2
        words = [rnd.choice(good) + str(rnd.randrange(9)) for _ in range(60)] if q else [rnd.choice(good) + rnd.choice(bad) for _ in range(60)]
        text = " ".join(words + [rnd.choice(toxic)] * (2 * t))
        docs.append((i, text, "en", f"h{i % 4}", 0.0))
        if i % 2:
            labels.append((i, int(q), int(t)))
    truth = {i: ("%" not in t and "$" not in t and "*" not in t and "#" not in t, "idiot" in t or "moron" in t) for i, t, *_ in docs}
    docs += [(None, None, None, None, 0.0), (1000, "", "en", "h0", 0.0), docs[0]]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n double")
    known = spark.createDataFrame([*labels, (3, None, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classify(df, known).collect()}
    held = [i for i in truth if i % 2 == 0]
    right = np.mean([got[i]["kept"] == (truth[i][0] and not truth[i][1]) for i in held])
    assert right > 0.97 and len(got) == 602
    assert all(r["kept"] for r in quality.classify(df, known.where("false")).collect())
    assert quality.classify(df.where("false"), known).count() == 0


def test_few_labels_find_toxic_documents(spark):
    docs, labels = [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]
    weights = quality.fit(docs, labels)[0]
    insults = {"trash", "clown", "idiot", "scum", "worthless", "moron", "pathetic", "loser", "disgusting", "stupid"}
    assert insults <= {w for w, x in weights.items() if x[1] > 0}
    rows = quality.classify(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("quality is not null and toxic is not null").collect()
    marked = [r for r in rows if insults & set(quality._WORD.findall(r["text"].lower()))]
    assert len(marked) == 33 and all(r["toxic"] and r["toxic_score"] >= 0.5 and not r["kept"] for r in marked)
    assert not any(r["toxic_score"] >= 0.5 for r in rows if not r["toxic"])


def test_links_refuse_a_radius_that_loses_links(spark):
    classes = spark.createDataFrame([(0b01 | 0b01 << 32,), (0b10 | 0b10 << 32,)], "fp long")  # four bits apart, two in each half
    with pytest.raises(ValueError, match="radius 4"):
        simhash.links(classes, 4)


def test_every_word_with_evidence_carries_weight(spark):
    """A word of four documents, all of them toxic, of few toxic ones; and more such words than any fixed number."""
    rare = [f"rare{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(60 % 26)]
    rows = [(i, "plain words of text " + ("vile " + " ".join(rare) if i < 4 else "")) for i in range(399)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 51)) for i in range(399)], "doc_id long, quality int, toxic int")
    weights = quality.fit(docs, labels)[0]
    assert {"vile", *rare} <= weights.keys() and all(weights[w][1] > 0 for w in rare)
