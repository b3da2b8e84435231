"""Operators 1 and 10."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from colline.llm import minhash_dedup as D
from colline.llm.components import components
from colline.llm.mixing import CYCLE, Mix


# ---- near-dedup -----------------------------------------------------------------------


def _shingles(text, width):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def _brute_components(rows, width):
    sets = [_shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out[i] = min(ids, default=None)
    return [(doc, len(sets[i]), out[i], doc == out[i]) for i, (doc, _) in enumerate(rows)]


def _families(rnd):
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(12)]
    texts = []
    for _ in range(8):
        base = [word() for _ in range(rnd.randrange(20, 60))]
        for _ in range(rnd.randrange(1, 8)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 5)):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [" ".join(passage + [word() for _ in range(rnd.randrange(4, 30))]) for _ in range(40)]
    return texts


@pytest.mark.parametrize("width,small_key", [(2, 24), (2, 2), (5, 24)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, width, small_key):
    monkeypatch.setattr(D, "SMALL_KEY", small_key)
    rnd = random.Random(width * 100 + small_key)
    texts = _families(rnd) + ["", None, "  \n ", "one", "ONE", "One two", "one TWO", "İx a b c d e", "same " * 30, "same " * 31, "w " * 4000]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rnd.shuffle(rows)
    rows += [(None, "one"), (None, "null id only"), (None, "no id either"), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, "k", b"s") for r in rows], "doc_id long, text string, key string, sig binary")
    got = D.near_duplicates(docs, width=width)
    have = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect())
    want = Counter(_brute_components(rows, width))
    fixed = Counter({(d, n, c, True if d is None and c is None else k): m for (d, n, c, k), m in want.items()})
    assert have == fixed
    left = D.deduplicated(docs, width=width)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.where("doc_id is not null").collect()]
    nulls = sorted(r.text for r in left.where("doc_id is null").collect())
    assert nulls == ["no id either", "null id only"]
    assert len(ids) == len(set(ids)) and set(ids) == {c for d, n, c, k in want if c is not None and k}


def test_near_duplicates_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert D.near_duplicates(docs).collect() == [] and D.deduplicated(docs).collect() == []


def test_signature_keys_meet_within_the_promised_distance(spark):
    rnd = random.Random(1)
    base = [rnd.randrange(65536) for _ in range(D.PLACES)]
    rows = [(b"0" * 16, base)]
    for k in range(30):
        other = list(base)
        for p in rnd.sample(range(D.PLACES), 2 * D.CHUNKS - 1):
            other[p] ^= 1
        rows.append((b"%016d" % (k + 1), other))
    keys = D._keys(spark.createDataFrame(rows, "set_id binary, sig array<int>")).collect()
    by = {}
    for r in keys:
        by.setdefault(bytes(r.set_id), set()).add(r.key)
    assert all(len(v) == D.CHUNKS * D.CHUNK for v in by.values())
    assert all(by[b"0" * 16] & v for v in by.values())


def test_parities_never_exceed_the_set_difference():
    rnd = random.Random(7)
    for size in (0, 1, 40, 900, 20000):
        a = {rnd.getrandbits(64) for _ in range(size)}
        b = {x for x in a if rnd.random() < 0.9} | {rnd.getrandbits(64) for _ in range(size // 10)}
        x, y = (D.parities(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
        assert len(x) * 64 == D.PARITY_BITS
        assert sum(((int(i) ^ int(j)) & (2**64 - 1)).bit_count() for i, j in zip(x, y)) <= len(a ^ b)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# ---- mixing ---------------------------------------------------------------------------


def _brute_targets(sizes, total=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: CYCLE[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(sizes), total * sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= cap * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mix_hits_targets(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(6000):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "é", None, "Z", "tiny"]) if i % 50 else "rare"
        rows.append((i, " ".join(["w"] * int(rnd.paretovariate(1.2) * 5 % 300)), source))
    docs = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "doc_id long, text string, source string, size int, target double")
    mix = Mix(docs)
    got = mix.counts().collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = _brute_targets(sizes)
    taken, biggest = Counter(), Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size) and r.copies in (0, 1, 2)
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s] / 2 + 1
    copies = {r.doc_id: r.copies for r in got}
    assert {r.doc_id: r.copies for r in Mix(docs).counts().collect()} == copies
    applied = mix.apply(docs)
    assert applied.columns == docs.columns
    assert Counter(r.doc_id for r in applied.collect()) == Counter({d: c for d, c in copies.items() if c})


def test_mix_prefers_by_inclusion_odds(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b c d' as text", "'s' as source", "id % 2 as liked")
    weights = spark.createDataFrame([("s", 1.0)], "source string, weight double")
    from pyspark.sql import functions as F

    flat = Mix(docs, weights, total=0.5, preference=F.lit(1.0)).counts().where("taken > 0")
    liked = Mix(docs, weights, total=0.5, preference=F.when(F.col("_id") % 2 == 1, F.lit(9.0)).otherwise(F.lit(1.0))).counts().where("taken > 0")
    assert flat.count() == liked.count() == 2000
    share = lambda df: df.where("doc_id % 2 = 1").count() / 2000
    assert 0.45 < share(flat) < 0.55 and share(liked) > 0.7


def test_mix_edges(spark):
    schema = "doc_id long, text string, source string"
    assert Mix(spark.createDataFrame([], schema)).counts().collect() == []
    rows = [(1, None, "a"), (2, "", None), (None, "x y", None), (None, "x y", None), (3, " \t", "b")]
    got = Mix(spark.createDataFrame(rows, schema)).counts().collect()
    assert len(got) == 5 and all(0 <= r.taken <= 2 * r.size for r in got)
    none = spark.createDataFrame([("other", 1.0)], "source string, weight double")
    assert all(r.taken == 0 for r in Mix(spark.createDataFrame([(1, "x", "a")], schema), none).counts().collect())
