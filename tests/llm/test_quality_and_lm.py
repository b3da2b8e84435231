"""Operators 4 and 5."""

from __future__ import annotations

import math
import time
from collections import Counter, defaultdict
from functools import cached_property
from itertools import permutations

import numpy as np

from colline.llm import kneser_ney as K
from colline.llm.quality_rules import (
    RULES, SAMPLED_PER_PARTITION, Rule, Text, base_failed, cascade_order, estimate_order, quality_rules, time_rules,
)

from ..conftest import TESTDATA


def _brute_measures(text):
    import re

    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def test_measures_and_verdict(spark, hard_docs):
    order = list(range(len(RULES)))
    got = quality_rules(hard_docs, keep=["n_tokens", "text"]).collect()
    back = quality_rules(hard_docs, order=order[::-1]).collect()
    assert len(got) == hard_docs.count()
    for r in got:
        m = _brute_measures(r["_keep1"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0])
        assert r.kept == (not r.base_failed and not any(x.rejects(Text(r["_keep1"])) for x in RULES))
    assert sorted((r.doc_id or -1, r.kept) for r in got) == sorted((r.doc_id or -1, r.kept) for r in back)
    assert quality_rules(hard_docs.limit(0)).collect() == []


def test_cascade_takes_rejection_per_cost_among_survivors():
    # rule 0 rejects most but costs much; rule 2 only rejects what rule 1 rejects
    sampled = [(0b001, 50), (0b110, 30), (0b000, 20)]
    assert cascade_order(sampled, [10.0, 1.0, 1.5]) == [1, 0, 2]
    assert cascade_order([], [2.0, 1.0]) == [1, 0]


def test_shared_measures_are_charged_to_the_first_rule_in_any_list_order():
    rules = [Rule("a", None, ("letters",)), Rule("b", None, ("letters",)), Rule("c", None)]
    hits, costs = {"a": 30, "b": 30, "c": 20}, {"a": 1.0, "b": 1.1, "c": 1.0}
    for perm in permutations(range(3)):
        mine = [rules[k] for k in perm]
        sampled = [(1 << k, hits[r.name]) for k, r in enumerate(mine)] + [(0, 20)]
        order = cascade_order(sampled, [costs[r.name] for r in mine], mine, {"letters": 9.0})
        # alone a and b cost 10; once a has paid, b costs 1.1
        assert [mine[k].name for k in order] == ["c", "a", "b"]


def test_timing_does_not_depend_on_the_list_order(monkeypatch):
    def slow(self):
        time.sleep(0.01)
        return 50, 0, 50

    letters = cached_property(slow)
    letters.__set_name__(Text, "letters")
    monkeypatch.setattr(Text, "letters", letters)
    texts = ["one two", None, " ".join(f"w{i}" for i in range(30)), "x y " * 40]
    for rules in (RULES, RULES[::-1]):
        ((bits, spent),) = time_rules(texts, rules)  # the others fail the base
        assert bits == sum(r.rejects(Text(texts[2])) << k for k, r in enumerate(rules))
        assert len(spent) == len(rules) + 1 and spent[-1] >= 0.01 > 2 * max(spent[:-1])


def test_columns_with_dots_and_few_rows_to_python(spark):
    docs = spark.range(5000).selectExpr("id as `doc.id`", "repeat(concat('w', id, ' '), 20) as `a.b`", "1 as `kept`", "2 as `x.y`").repartition(2)
    got = quality_rules(docs, "doc.id", "a.b", keep=["x.y", "kept"])
    assert got.count() == 5000 and got.where("_keep0 = 2 and _keep1 = 1").count() == 5000
    seen = spark.sparkContext.accumulator(0)

    def look(t):
        seen.add(1)
        return False

    text = spark.range(5000).selectExpr("array_join(transform(sequence(0, 30), i -> concat('w', id, '_', i)), ' ') as text").repartition(2)
    assert estimate_order(text, rules=[Rule("look", look)]) == [0]
    assert 0 < seen.value <= 2 * SAMPLED_PER_PARTITION


def test_cascade_stops_at_the_first_rejection(spark):
    def explode(t):
        raise AssertionError("not reached")

    rules = [Rule("all", lambda t: True), Rule("never", explode)]
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "doc_id long, text string")
    assert [r.rejected_by for r in quality_rules(docs, rules=rules, order=[0, 1]).collect()] == ["all"]


def test_clean_labelled_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    rows = quality_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert not any(r.kept for r in rows if r.quality == 0)
    assert sorted(estimate_order(docs)) == list(range(len(RULES)))


def _brute_kn(texts):
    """Interpolated modified Kneser-Ney over tuples of classes, straight from the definition."""
    grams = {k: Counter() for k in range(1, K.ORDER + 1)}
    lines = [[K.BEFORE] * (K.ORDER - 1) + [c if c < K.FOLDED else K.FOLDED + c % (K.CLASSES - K.FOLDED) for c in map(ord, t)] + [K.AFTER] for t in texts if t]
    for line in lines:
        for i in range(K.ORDER - 1, len(line)):
            grams[K.ORDER][tuple(line[i - K.ORDER + 1 : i + 1])] += 1
    for k in range(K.ORDER - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    d = {}
    for k, c in grams.items():
        n = Counter(c.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d[k] = [min(max(j - (j + 1) * y * n[j + 1] / n[j] if n[1] and n[j] else j / 2, 0.05 * j), 0.95 * j) for j in (1, 2, 3)]
    sums = {k: defaultdict(lambda: [0, 0.0]) for k in grams}
    for k, c in grams.items():
        for g, n in c.items():
            sums[k][g[:-1]][0] += n
            sums[k][g[:-1]][1] += d[k][min(n, 3) - 1]

    def p(g):
        if not g:
            return 1 / K.CLASSES
        k = len(g)
        total, mass = sums[k].get(g[:-1], (0, 0))
        low = p(g[1:])
        if not total:
            return low
        n = grams[k].get(g, 0)
        return (n - d[k][min(n, 3) - 1] if n else 0) / total + mass / total * low

    def perplexity(text):
        line = [K.BEFORE] * (K.ORDER - 1) + [c if c < K.FOLDED else K.FOLDED + c % (K.CLASSES - K.FOLDED) for c in map(ord, text or "")] + [K.AFTER]
        logs = [math.log(p(tuple(line[i - K.ORDER + 1 : i + 1]))) for i in range(K.ORDER - 1, len(line))]
        return math.exp(-sum(logs) / len(logs))

    return perplexity


def test_kneser_ney_equals_the_definition(spark):
    en = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "日本の猫"]
    de = ["die katze sitzt", "der hund sitzt auf der matte"]
    others = ["the cat", "xyzzy!!", "", None, "the the the", "die katze"]
    rows = [(i, t, "en") for i, t in enumerate(en)] + [(10 + i, t, "de") for i, t in enumerate(de)]
    rows += [(20 + i, t, "en") for i, t in enumerate(others)] + [(30, "die matte", "de"), (31, "sans modele", "fr"), (32, "x", None), (None, "the cat", "en")]
    rows += [(20, "the cat", "en")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, perplexity string, c int")
    trusted = spark.createDataFrame([(i,) for i in [0, 1, 2, 3, 10, 11, 11, None]], "doc_id long")
    models = {"en": _brute_kn(en), "de": _brute_kn(de)}
    got = K.classify(docs, trusted, held_out=0).collect()
    assert len(got) == len(rows)
    texts = {(r[0], r[2] or ""): r[1] for r in rows}
    for r in got:
        if r.lang in models:
            want = models[r.lang](texts[r.doc_id, r.lang])
            assert abs(r.perplexity - want) < 1e-9 * want, r
            assert r.kept == (r.perplexity <= r.threshold)
        else:
            assert r.perplexity is None and r.threshold is None and r.kept
    limits = {r.lang: r.threshold for r in got}
    assert abs(limits["de"] - max(models["de"](t) for t in de) * K.MARGIN) < 1e-9
    assert K.classify(docs.limit(0), trusted).collect() == []


def test_text_grams_pack_and_fold():
    g = K.text_grams("az")
    assert [[int(x) >> (12 * k) & 4095 for k in (3, 2, 1, 0)] for x in g] == [[2, 2, 2, 97], [2, 2, 97, 122], [2, 97, 122, 3]]
    assert int(K.text_grams("中")[0]) & 4095 == 3072 + ord("中") % 1024
    assert K.text_grams("").tolist() == [2 << 36 | 2 << 24 | 2 << 12 | 3] and np.all(K.text_grams("x" * 5000) > 0)


def test_junk_is_told_from_held_out_clean_text(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    good = labels.where("quality = 1 and toxic = 0 and doc_id % 2 = 0").select("doc_id")
    rows = K.classify(docs, good).join(labels.where("doc_id % 2 = 1"), "doc_id").where("n_grams > 200").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.9 and np.mean(junk) < 0.1
