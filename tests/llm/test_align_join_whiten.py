"""Alignment, Jaccard join and whitening against brute force, with nulls, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from colline.llm import alignment as L
from colline.llm.jaccard_join import jaccard_components, similar_sets
from colline.llm.queries import BYTE_VOCABULARY, QUERIES, vocabulary
from colline.llm.whitening import fit_whitening, one_sided_jacobi, pivoted_cholesky, whiten, whitened_rows

from ..conftest import TESTDATA
from .conftest import HARD_TEXTS

SF = f"{TESTDATA}/sf0.001"


# ---- operator 11 ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def byte_json():
    return vocabulary(BYTE_VOCABULARY)


@pytest.fixture(scope="module")
def encoders(byte_json, model):
    return L.Encoders(byte_json, model)


def _spans(ids, table):
    ends = np.cumsum([len(table[i]) for i in ids]).tolist()
    return list(zip([0, *ends], ends))


def _tokens(e, text):
    want = b" " + (text or "").encode()
    a = e.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = e.b.encode(text) if text else []
    spelled = b"".join(e.a_bytes[i] for i in a) == want and b"".join(e.b_bytes[i] for i in b) == want
    return (a, b) if spelled else ([], [])


def _brute(e, texts):
    """The columns of the query for each text, from its spans alone."""
    links, parts = [], []
    for t in texts:
        a, b = _tokens(e, t)
        sa, sb = _spans(a, e.a_bytes), _spans(b, e.b_bytes)
        links.append([(x, y) for x, (s, f) in zip(a, sa) for y, (p, q) in zip(b, sb) if max(s, p) < min(f, q)])
        ends = sorted({f for _, f in sa} & {f for _, f in sb})
        groups = []
        for low, high in zip([0, *ends], ends):
            side = lambda ids, spans: ",".join(str(i) for i, (s, f) in zip(ids, spans) if low < f <= high)  # noqa: B023, E731
            groups.append(side(a, sa) + "|" + side(b, sb))
        parts.append((len(a), len(b), len(groups), sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    held = Counter(p for x in links for p in set(x))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [
        (n_a, n_b, n_g, len(x), sum(held[p] == best[p[0]] for p in x), sum(held[p] for p in x), digest)
        for x, (n_a, n_b, n_g, digest) in zip(links, parts)
    ]


def test_alignment_equals_brute_force(spark, hard_docs, byte_json, model, encoders):
    texts = [r.text for r in hard_docs.collect()]
    got = L.alignment_counts(hard_docs, byte_json, model).collect()
    ids = [r.doc_id for r in hard_docs.collect()]
    want = Counter((i, *w) for i, w in zip(ids, _brute(encoders, texts)))
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == want
    empty = L.alignment_counts(hard_docs.where("doc_id < 0"), byte_json, model)
    assert empty.collect() == [] and empty.columns == L.alignment_counts(hard_docs, byte_json, model).columns


def test_alignment_over_several_blocks(spark, byte_json, model, encoders, monkeypatch):
    rnd = random.Random(5)
    words = "the of and a1 don't naïve 中文 x▁y  two\nlines 🙂".split(" ")
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 30))) for _ in range(120)]
    monkeypatch.setattr(L, "BLOCK_BYTES", 400)
    parts = [L._block_row(encoders, k, list(range(i, j)), texts[i:j]) for k, (i, j) in enumerate(L._blocks(texts))]
    assert len(parts) > 5 and sum(len(p.column("doc_id")[0]) for p in parts) == len(texts)
    held = Counter()
    for p in parts:
        held.update(dict(zip(p.column("pairs")[0].as_py(), p.column("held")[0].as_py())))
    width = len(encoders.b_bytes)
    want = Counter()
    for t in texts:
        x = L.align(encoders, [t])
        want.update(set((x.a_ids[x.link_a] * width + x.b_ids[x.link_b]).tolist()))
    assert held == want


def test_words_are_encoded_as_in_their_text(encoders):
    rnd = random.Random(3)
    pool = [" ", "  ", "\n", "\t", " ", "\x85", "\x1c", "᠎", "​", "a", "B", "'s", "1", "½", "é", "中", "!", "<|endoftext|>", "<s>", "▁", "\x00", "🙂"]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(1, 14))) for _ in range(3000)] + [t for t in HARD_TEXTS if t]
    got = zip(*encoders.encode(texts))
    for t, (a, b) in zip(texts, got):
        want = _tokens(encoders, t)
        assert (np.frombuffer(a, np.int32).tolist(), np.frombuffer(b, np.int32).tolist()) == want, repr(t)


def test_alignments_give_spans_and_links(spark, byte_json, model, encoders):
    docs = spark.createDataFrame([(1, "naïve tokenization, 中文"), (2, None), (3, "a▁b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in L.alignments(docs, byte_json, model).collect()}
    a, b = _tokens(encoders, "naïve tokenization, 中文")
    sa, sb = _spans(a, encoders.a_bytes), _spans(b, encoders.b_bytes)
    assert rows[1].a_ids == a and rows[1].b_ids == b and rows[1].a_ends == [f for _, f in sa]
    assert rows[1].group_ends == sorted({f for _, f in sa} & {f for _, f in sb})
    want = {(i, j) for i, (s, f) in enumerate(sa) for j, (p, q) in enumerate(sb) if max(s, p) < min(f, q)}
    assert {(x.a, x.b) for x in rows[1].links} == want
    assert rows[2].links == rows[3].a_ids == []


def test_alignment_query_equals_brute_force(spark, encoders):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text or "") < 3000]
    small = spark.createDataFrame([(r.doc_id, r.text) for r in docs], "doc_id long, text string")
    got = L.alignment_counts(small, vocabulary(BYTE_VOCABULARY), vocabulary("piece_bpe_32k.model")).collect()
    want = {r.doc_id: w for r, w in zip(docs, _brute(encoders, [r.text for r in docs]))}
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got} == want
    assert QUERIES["op11_alignment"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


# ---- operator 12 ------------------------------------------------------------------------


def _shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def _brute_components(rows, width=3, percent=90):
    sets = [_shingles(t, width) for _, t in rows]
    of = list(range(len(rows)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                of[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return Counter((d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def _components(spark, rows, **args):
    docs = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, n int, component_id int")
    return Counter(tuple(r) for r in jaccard_components(docs, **args).collect())


def test_join_equals_brute_force_on_relatives(spark):
    """Chains and stars of edited texts around the threshold, a shared passage, copies, ties and short texts."""
    rnd = random.Random(11)
    word = lambda: "w%d" % rnd.randrange(10**6)
    passage = [word() for _ in range(60)]
    texts = []
    for size in (12, 30, 45, 90, 140):
        base = [word() for _ in range(size)]
        for _ in range(10):
            t = list(base)
            for _ in range(rnd.randrange(5)):
                t[rnd.randrange(size)] = word()
            texts.append(t)
            if rnd.random() < 0.4:
                base = t  # a chain
    texts += [passage + [word() for _ in range(rnd.randrange(12))] for _ in range(15)]
    texts += [passage + [word() for _ in range(200)] for _ in range(8)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(900, "One two THREE"), (901, "one  two\nthree"), (902, "one two"), (903, "one two"), (904, "one"), (905, ""), (906, None), (None, None)]
    rows += [(None, rows[0][1]), (907, " \t"), (0, rows[0][1]), (908, "x " * 300), (909, "x " * 400)]
    assert _components(spark, rows) == _brute_components(rows)


def test_join_with_other_thresholds_and_empty_tables(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices("abcdef", k=rnd.randint(1, 12)))) for i in range(60)]
    for width, percent in ((1, 70), (2, 80)):
        assert _components(spark, rows, width=width, percent=percent) == _brute_components(rows, width, percent)
    assert _components(spark, []) == Counter()


def test_join_skips_pairs_of_joined_sets(spark):
    """A group of near copies is joined through one set: far fewer links than pairs."""
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(base[:k] + [f"n{i}"] + base[k + 1 :])) for i, k in enumerate(random.Random(4).choices(range(150), k=120))]
    rows.append((500, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, _, links = similar_sets(docs)
    assert links.count() < 300
    assert {r.component_id for r in jaccard_components(docs).collect()} == {0}


# ---- operator 13 ------------------------------------------------------------------------


def test_factor_and_rotations_against_numpy():
    rng = np.random.default_rng(0)
    for d, rank in ((1, 1), (7, 7), (24, 24), (20, 6)):
        x = rng.normal(size=(200, rank)) @ rng.normal(size=(rank, d)) * 10.0 ** rng.integers(-3, 3, d)
        a = x.T @ x
        g = pivoted_cholesky(a)
        assert g.shape == (d, rank) and np.allclose(g @ g.T, a, rtol=1e-10, atol=1e-10 * np.abs(a).max())
        values, vectors = one_sided_jacobi(g)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-12 * values[0])
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-11 * values[0])
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, n int")


def test_whitening_equals_exact_sums(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(80, 5)) * [1, 10, 0.5, 3, 2]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(3, rows[3][1]), (100, rows[4][1]), (None, rows[5][1])]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, [])]
    got = whitened_rows(_vectors(spark, rows + bad)).collect()
    x = np.floor(64 * np.array([v for _, v in rows])).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    assert {r.n for r in got} == {80} == {n} and len(got) == 5 * len(rows)
    want = Counter((i, int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s)))) for (i, _), v in zip(rows, x))
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    values, vectors = np.linalg.eigh((fit - s / n).T @ (fit - s / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = (x - s / n) @ vectors / np.sqrt(values)
    for k in range(5):
        mine = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        sign = np.sign(mine[0] * z[0, k])
        assert all(abs(mine[i] - sign * z[j, k]) < 1e-9 for j, (i, _) in enumerate(rows))
        assert all(r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9) for r in got if r.component == k + 1)
    assert 0 <= got[0].identity_error < 1e-9


def test_whitening_of_large_entries_few_vectors_and_empty_tables(spark):
    large = [(0, [1e18, 0.0]), (1, [-1e18, 1.0]), (2, [2.0**70, 3.0])]
    rows, model = whiten(_vectors(spark, large))
    assert model.n == 3 and model.identity_error < 1e-4
    assert all(r.deviation is None for r in rows.collect())  # beyond a BIGINT
    rows, model = whiten(_vectors(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0])]))
    assert model.n == 1 and [(r.deviation, r.whitened) for r in rows.collect()] == [(0, []), (0, [])]
    assert whitened_rows(_vectors(spark, [])).collect() == []
    assert whitened_rows(_vectors(spark, [(1, None)])).collect() == []
    with pytest.raises(Exception, match="different lengths"):
        fit_whitening(_vectors(spark, [(0, [1.0]), (1, [1.0, 2.0])]))


def test_whitening_query(spark):
    got = QUERIES["op13_whitening"](spark, SF).collect()
    z = np.array([r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component))]).reshape(-1, 16)
    assert np.abs(z.T @ z / len(z) - np.eye(16)).max() < 1e-9
