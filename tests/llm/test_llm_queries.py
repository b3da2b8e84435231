"""The registered queries: against their SQL, the library, or a brute-force version on whole small tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from colline.llm import url_filters as U
from colline.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i] + 0.0) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


def test_operators_are_registered():
    assert [re.match(r"op(\d+)_", q)[1] for q in QUERIES] == [str(n) for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(columns, want.fetchall())


def test_token_queries_equal_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {d: library.encode(t) for d, t in docs.items()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    assert got == {d: (len(t.encode()), len(ids[d]), len(ids[d]) > 4096) for d, t in docs.items()}
    digest = lambda s: sha256(s.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op9_sentencepiece"](spark, SF).collect()}
    assert got == {d: (len(i), digest(",".join(map(str, i))), digest(library.decode(i))) for d, i in ids.items()}


def _brute_urls(urls):
    """(host, path, rule, verdict, template) of every url, straight from the definition."""
    parsed = []
    for u in urls:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, rule, verdict = max(fits, default=(0, None, None))
        parsed.append((host, path, rule, verdict))
    count = Counter((h, p) for h, p, _, _ in parsed)
    segments = {k: re.sub("^/", "", k[1]).split("/", U.DEPTH) for k in count}
    template, parent = {k: "" for k in count}, {k: "" for k in count}
    for level in range(max(map(len, segments.values()), default=0)):
        children, total = defaultdict(set), Counter()
        for k, s in segments.items():
            if len(s) > level:
                children[k[0], template[k]].add(s[level])
                total[k[0], template[k]] += count[k]
        now = dict(template)
        for k, s in segments.items():
            if len(s) > level:
                node = (k[0], template[k])
                variable = len(children[node]) >= U.MANY and len(children[node]) >= total[node] * U.DIFFERENT
                if variable or re.search(U.ID_FORM, s[level]):
                    ending = re.search(r"\.[A-Za-z0-9]{1,5}$", s[level])
                    now[k] = template[k] + "/*" + (ending[0] if ending else "")
                else:
                    now[k] = template[k] + "/" + s[level]
                parent[k] = template[k]
        template = now
    leaf = defaultdict(lambda: [0, 0])
    for h, p, _, v in parsed:
        if v:
            x = leaf[h, parent[h, p], template[h, p]]
            x[0] += v == "block"
            x[1] += 1
    pool = defaultdict(lambda: [0, 0])
    for (h, p, _), (b, n) in leaf.items():
        pool[h, p][0] += b
        pool[h, p][1] += n
    named, classes = {}, defaultdict(lambda: [0, 0])
    for k in {(h, parent[h, p], template[h, p]) for h, p in count}:
        b, n = leaf.get(k, (0, 0))
        pb, pn = pool.get(k[:2], (0, 0))
        share = pb / pn if pn else 0
        merged = n > 0 and not abs(b - n * share) > U.Z * math.sqrt(n * share * (1 - share))
        named[k] = (k[0], k[1] + "/{merged}" if merged else k[2])
        classes[named[k]][0] += b
        classes[named[k]][1] += n
    out = []
    for h, p, rule, verdict in parsed:
        b, n = classes[named[h, parent[h, p], template[h, p]]]
        purity = (b + U.SMOOTHING / 2) / (n + U.SMOOTHING)
        out.append((h, p, rule, verdict or ("block" if purity >= U.PURITY else "allow"), template[h, p]))
    return out


def test_url_query_equals_brute_force(spark):
    sf = f"{TESTDATA}/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    want = {p.page_id: w for p, w in zip(pages, _brute_urls([p.url for p in pages]))}
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.template) for r in QUERIES["op6_url_templates"](spark, sf).collect()}
    assert got == want


def test_surrogate_query_keeps_entities_distinct(spark):
    form = re.compile(r"[\w.]+@mail\d\.example\.com|\+\d \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b(?:[0-9a-f]{40}|[0-9A-F]{40})\b|\b\d{1,3}(?:\.\d{1,3}){3}\b")
    loose = re.compile(form.pattern.replace(r"@mail\d\.example\.com", r"@\w+\.example\.(?:com|org|net)"))
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pairs = set()
    for r in QUERIES["op8_pii_surrogates"](spark, SF).collect():
        old, new = form.findall(docs[r.doc_id]), loose.findall(r.text)
        assert len(old) == len(new) == r.n_entities and form.sub("", docs[r.doc_id]) == loose.sub("", r.text)
        pairs |= {(re.sub(r"\s", "", a.lower()), b.lower()) for a, b in zip(old, new)}
    assert pairs and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert not {a for a, _ in pairs} & {b for _, b in pairs}
