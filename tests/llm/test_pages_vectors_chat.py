"""Operators 3, 6 and 7."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from colline.llm import block_topk as B
from colline.llm.chat import chat_documents, maximal_conversations
from colline.llm.url_filters import host_of, judge_urls, path_of


# ---- chat -----------------------------------------------------------------------------


def _conversations(spark, convs):
    rows = [(c, k, r, t) for c, turns in convs for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], "conv_id long, turn long, role string, text string, chunk string, k int")


def _render(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


def test_snapshots_collapse(spark):
    a = [("user", "hi"), ("assistant", "hello"), ("user", "bye")]
    other = [("user", "hi"), ("assistant", "no")]
    moved = [("assistant", "hello"), ("user", "hi")]
    convs = [(1, a[:1]), (2, a[:2]), (3, a), (4, a), (5, other), (6, moved), (7, [("user", None)]), (8, [("user", "")]), (9, [(None, "x")])]
    convs += [(100 + i, a[: 1 + i % 3]) for i in range(300)]
    df = _conversations(spark, convs)
    got = {r.conv_id: (r.part, r.n_turns, r.text) for r in chat_documents(df).collect()}
    assert got == {3: (0, 3, _render(a)), 5: (0, 2, _render(other)), 6: (0, 2, _render(moved)), 7: (0, 1, _render([("user", "")])), 9: (0, 1, _render([("", "x")]))}


def test_long_conversation_is_rendered_in_parts(spark):
    turns = [("user" if k % 2 else "assistant", f"t{k}") for k in range(2500)]
    df = _conversations(spark, [(1, turns[:2300]), (2, turns), (3, turns[:2299] + [("user", "other")])])
    assert {r.conv_id: r.n_turns for r in maximal_conversations(df).collect()} == {2: 2500, 3: 2300}
    rows = sorted((r.conv_id, r.part, r.text) for r in chat_documents(df).collect())
    assert [r[:2] for r in rows] == [(2, 0), (2, 1), (2, 2), (3, 0), (3, 1), (3, 2)]
    assert "".join(r[2] for r in rows[:3]) == _render(turns)


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat_documents(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "user", "n"), (2, 0, "user", "z")]
    got = {r.conv_id: (r.n_turns, r.text) for r in chat_documents(spark.createDataFrame(rows, schema)).collect()}
    assert got[None] == (2, _render([("user", "a"), ("user", "b")])) and got[1] == (1, _render([("user", "x")]))
    assert sum(n for n, _ in [got[2]]) == 2


# ---- urls -----------------------------------------------------------------------------

URLS = {
    "https://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "http://example.net/fr/1": ("example.net", "/fr/1", "net/", "block"),
    "http://badexample.net/en/1": ("badexample.net", "/en/1", "net/", "block"),
    "http://net": ("net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
    "http://x.example.com/de": ("x.example.com", "/de", None, "allow"),
    "ftp://o.org/fr/a?b=http://net/": ("o.org", "/fr/a", "org/fr/", "allow"),
    "no scheme/net/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://ÄB.org?q/fr/": ("Äb.org", "", None, "allow"),
    "http://h.org#a/b": ("h.org", "", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
}


def test_rules_and_parsing(spark):
    rows = list(enumerate(URLS)) + [(None, "http://net/"), (0, next(iter(URLS)))]
    df = spark.createDataFrame([(*r, "clash", "x") for r in rows], "page_id long, url string, host string, template string")
    got = judge_urls(df).collect()
    assert len(got) == len(rows)
    named = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert [named[i] for i in range(len(URLS))] == list(URLS.values())
    assert named[None] == ("net", "/", "net/", "block")
    assert judge_urls(df.limit(0)).collect() == []


def test_templates_purity_and_merging(spark):
    rules = [("block", f"bad{k}.org", "/") for k in range(3)] + [("block", "site.org", "/a/x"), ("allow", "site.org", "/b/x")]
    urls = [f"http://site.org/a/x{i}" for i in range(20)] + [f"http://site.org/a/y{i}" for i in range(20)]
    urls += [f"http://site.org/b/x{i}" for i in range(20)] + [f"http://site.org/b/y{i}" for i in range(20)]
    urls += [f"http://site.org/c/{i}.html" for i in range(5)] + ["http://site.org/c/about"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {u: r for r in judge_urls(df, rules=rules).collect() for u in [urls[r.page_id]]}
    assert got["http://site.org/a/x3"].rule == "site.org/a/x" and got["http://site.org/a/x3"].template == "/a/*"
    # 20 of 20 labels under /a/* are blocked: its unlabelled urls go; /b/* is allowed; /c/ has no label
    assert got["http://site.org/a/y3"].verdict == "block" and got["http://site.org/a/y3"].rule is None
    assert got["http://site.org/b/y3"].verdict == "allow"
    assert got["http://site.org/c/2.html"].template == "/c/*.html" and got["http://site.org/c/about"].template == "/c/about"
    assert got["http://site.org/c/2.html"].verdict == "allow"


def test_labels_judge_undecided_pages_and_rules_only_their_segment(spark):
    urls = [f"http://x.example.com/de/p{i}" for i in range(6)] + [f"http://x.example.com/s{k}/p{k}" for k in range(7)]
    urls += [f"http://h.edu/ads/{i}" for i in range(12)] + [f"http://h.edu/news/{i}" for i in range(12)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    verdicts = lambda **more: {urls[r.page_id]: r.verdict for r in judge_urls(df, **more).collect()}
    plain = verdicts()
    assert {u for u, v in plain.items() if v == "block"} == set(urls[:6])
    rows = [(i, u, "/ads/" in u) for i, u in enumerate(urls) if "h.edu" in u and int(u.rsplit("/", 1)[1]) < 8] + [(3, urls[20], None)]
    labels = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    want = set(urls[:6]) | {u for u in urls if "/ads/" in u}
    for given in (labels.drop("page_id"), labels.drop("url")):
        got = verdicts(labels=given)
        assert {u for u, v in got.items() if v == "block"} == want and len(got) == len(urls)


def test_host_and_path_columns(spark):
    df = spark.createDataFrame([("x://h\n/p\nq?r",)], "url string").select(host_of(F.col("url")), path_of(F.col("url")))
    assert tuple(df.first()) == ("h\n", "/p\nq")


# ---- top-k ----------------------------------------------------------------------------


def _brute_top(rows, k):
    w = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, x) in enumerate(w):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for other, (i, y) in enumerate(w) if other != at)[:k]
            out += [(q, r + 1, i, -s if abs(s) < 2**63 else None) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


def _found(df):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in B.top_k(df).collect()), key=repr)


@pytest.mark.parametrize("sizes", [(2048, 128, 16 << 20, 4), (64, 8, 400, 3), (64, 8, 16 << 20, 1)])
def test_top_k_equals_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("RANGE", "BLOCK", "QUERY_BYTES", "GROUPS"), sizes, strict=True):
        monkeypatch.setattr(B, name, size)
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(500)]
    rows += [(1000 + i, rows[40][1]) for i in range(60)]  # many equal vectors: ties
    rows += [(2000, None), (2020, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2040, [float("nan")] * 6), (2060, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(2080, []), (2100, [9.0]), (-20, [1.0] * 9), (20, rows[20][1]), (20, [7.0] * 6), (21, rows[21][1]), (21, [5.0] * 6), (3000, [30000.0, -1.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, weights string")
    assert _found(df) == _brute_top(rows, 20)


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert B.top_k(spark.createDataFrame([], schema)).collect() == []
    assert B.top_k(spark.createDataFrame([(1, [1.0])], schema)).collect() == []
    few = B.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], schema)).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in few) == [(1, 1, 64 * 128), (2, 2, 64 * 128)]
    with pytest.raises(Exception, match="38 digits"):
        B.top_k(spark.createDataFrame([(0, [1e30]), (1, [1e30])], schema)).collect()


def test_large_components_have_exact_scores(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([1e9, -1e9, 3.0, 0.5, 1e8 + 1, 2e5]) for _ in range(3)]) for i in range(60)]
    rows += [(100, [1e15, 1.0, 0.0]), (101, [1e15, 2.0, 0.0]), (102, [1e-300, 2.0**70, 1.0]), (120, [4e7, 4e7, 4e7])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df) == _brute_top(rows, 20)


def test_scores_beyond_double_precision_are_exact(spark):
    rows = [(0, [float(2**24 + 1)] * 4), (1, [float(2**24 - 1)] * 4), (2, [float(2**24 - 1)] * 3 + [float(2**24)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df) == _brute_top(rows, 20)
