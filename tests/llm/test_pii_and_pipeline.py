"""Operator 8 and the pipeline."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline as P
from colline.llm import pii as PII
from colline.llm.minhash_dedup import shingle_set
from colline.llm.pii import pseudonymise, surrogates
from colline.llm.quality_rules import RULES, Text, base_failed
from colline.sources import storage

from ..conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def _one(spark, *texts, key="k"):
    rows = [(i, t, "clash", 3) for i, t in enumerate(texts)]
    out = pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, _row string, _n int"), key, count_col="found")
    assert out.columns == ["doc_id", "text", "_row", "_n", "found"]
    got = {r.doc_id: (r.text, r.found) for r in out.collect()}
    return [got[i] for i in range(len(texts))]


def test_formats_and_types(spark):
    texts = [
        "Write to Anna.Lee42@mail5.example.com now.",
        "call +1 (499) 555-6503 or 499-555-6503.",
        "from 97.51.17.173, not 1.2.3 or 999.1.1.1.2",
        'token = "ab8ca1b325bc4f85aa6a79e73fc4cbfc2098878e" TOKEN = "AB8CA1B325BC4F85AA6A79E73FC4CBFC2098878E"',
        "pay 9807915762804490, 4111 1111 1111 1111.",
        "Mrs. Anna Lee met Mr Lee and Herr Müller; господин Иван Петров.",
        "id 123-45-6789 iban DE89370400440532013000",
    ]
    got = _one(spark, *texts)
    mail = re.fullmatch(r"Write to ([a-z]{4}\.[a-z]{3}\d\d)@[a-z]{4}\d\.example\.(com|org|net) now\.", got[0][0])
    assert mail and got[0][1] == 1
    phone = re.fullmatch(r"call (\+\d \(\d{3}\) \d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})\.", got[1][0])
    assert phone and "499" not in phone[1]
    ip = re.fullmatch(r"from (2[45]\d\.\d+\.\d+\.\d+), not 1\.2\.3 or 999\.1\.1\.1\.2", got[2][0])
    assert ip and 240 <= int(ip[1].split(".")[0]) <= 254
    secret = re.fullmatch(r'token = "([0-9a-f]{40})" TOKEN = "([0-9A-F]{40})"', got[3][0])
    assert secret and secret[1].upper() == secret[2] and secret[1] not in texts[3]
    assert re.fullmatch(r"pay \d{16}, \d{4} \d{4} \d{4} \d{4}\.", got[4][0]) and got[4][1] == 2
    names = re.fullmatch(r"Mrs\. ([A-Z][a-z]+(?:na|lla|ra|ssa|lia)) ([A-Z][a-z]+) met Mr ([A-Z][a-z]+) and Herr ([A-Z][a-z]+); господин ([А-Я][а-я]+) ([А-Я][а-я]+)\.", got[5][0])
    assert names and names[2] == names[3] and names[4] != names[3]
    assert re.fullmatch(r"id \d{3}-\d{2}-\d{4} iban [A-Z]{2}\d{20}", got[6][0])
    for text, (new, n) in zip(texts, got):
        assert n and new != text


def test_coreference_across_documents_and_spellings(spark):
    got = _one(spark, "a@b.example.org x", "y A@B.EXAMPLE.ORG", "a@c.example.org", "+1 (499) 555-6503", "+1 499 555 6503", key="z")
    first = got[0][0].split()[0]
    assert got[1][0] == f"y {first.upper()}" and got[2][0] != first
    assert re.sub(r"\D", "", got[3][0]) == re.sub(r"\D", "", got[4][0])
    again = _one(spark, "a@b.example.org x", "y A@B.EXAMPLE.ORG", "a@c.example.org", "+1 (499) 555-6503", "+1 499 555 6503", key="z")
    assert again == got
    assert _one(spark, "a@b.example.org x", key="other")[0] != got[0]


def test_collisions_are_drawn_again(spark):
    # one-letter names and one domain: 26 plain draws for 26 letters and 10 digits
    rows = [("email", f"{c}@d.example.org") for c in "abcdefghijklmnopqrstuvwxyz0123456789"]
    rows += [("ip", f"240.0.{k}.1") for k in range(300)] + [("family:latin", f"name{k}") for k in range(3000)] + [("ssn", "1")]
    df = spark.createDataFrame(rows, "kind string, canon string")
    got = surrogates(df, "key").collect()
    assert Counter((r.kind, r.canon) for r in got) == Counter(rows)
    assert len({(r.kind, r.surrogate) for r in got}) == len(rows)
    assert not {(r.kind, r.surrogate) for r in got} & set(rows)


def test_names_of_many_words_and_scripts(spark):
    long = "Leutheusser-Schnarrenberger-Wolfeschlegelstein"
    many = " ".join(["Anna"] * 3000)
    got = _one(
        spark, "Mr John Paul Smith met Mr Smith and Mr Paul Smith.", f"Frau {long} und Frau Eva Maria {long}", f"Mrs {many} Lee",
        "Mr Νίκος Παππάς saw Ms Παππάς", "Mr Արամ Սարգսյան", "Mail שלום@d.example.org, 山田@d.example.org",
    )
    assert [n for _, n in got] == [3, 2, 1, 2, 1, 2]
    word = r"([A-Z][a-z]+)"
    first = re.fullmatch(rf"Mr {word} {word} {word} met Mr {word} and Mr {word} {word}\.", got[0][0])
    assert first and first[3] == first[4] == first[6] and first[2] == first[5] and first[1] != first[2]
    assert not {"John", "Paul", "Smith"} & set(first.groups())
    second = re.fullmatch(rf"Frau {word} und Frau {word} {word} {word}", got[1][0])
    assert second and second[1] == second[4]
    third = got[2][0].split(" ")
    assert len(third) == 3002 and len(set(third)) == 3 and not {"Anna", "Lee"} & set(third)
    greek = re.fullmatch(r"Mr ([\u0370-\u03ff]+) ([\u0370-\u03ff]+) saw Ms ([\u0370-\u03ff]+)", got[3][0])
    assert greek and greek[2] == greek[3] != "Παππάς"
    assert re.fullmatch(r"Mr [\u0531-\u0587]{4} [\u0531-\u0587]{8}", got[4][0]) and "Արամ" not in got[4][0]
    assert re.fullmatch(r"Mail [\u05d0-\u05ea]{4}@\w\.example\.\w+, [\u4e00-\u9fff]{2}@\w\.example\.\w+", got[5][0])


def test_long_secrets_are_replaced_whole(spark):
    rnd = random.Random(5)
    draw = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"
    jwt = f"eyJ{draw(base64, 97)}.{draw(base64, 400)}.{draw(base64, 98)}"
    twin = jwt[:300] + draw(base64, 300)
    hex_, signature = draw("0123456789abcdef", 512), draw("0123456789ABCDEF", 129)
    huge = draw(base64, 100_000)
    assert len(jwt) == 600
    texts = [f"token={jwt} end", f'secret: "{twin}" end', f"key {hex_} end", f"sig {signature}, end", f"{hex_.upper()}", f"password={huge} end"]
    got = _one(spark, *texts)
    new = [re.fullmatch(r'(?:token=|secret: "|key |sig |password=|)([^\s",]+)(?:"|,)?(?: end)?', t)[1] for t, _ in got]
    old = [jwt, twin, hex_, signature, hex_.upper(), huge]
    assert [n for _, n in got] == [1] * 6
    assert [len(s) for s in new] == [len(s) for s in old]
    for a, b in zip(old, new):
        assert not {a[i : i + 12] for i in range(len(a) - 11)} & {b[i : i + 12] for i in range(len(b) - 11)}
        # no part of the hash comes again
        assert len({b[i : i + 16] for i in range(len(b) - 15)}) == len(b) - 15
    assert re.fullmatch("[0-9a-f]{512}", new[2]) and new[4] == new[2].upper() and re.fullmatch("[0-9A-F]{129}", new[3])
    assert [i for i, c in enumerate(new[0]) if c == "."] == [i for i, c in enumerate(jwt) if c == "."]
    assert new[0][:300] != new[1][:300]


def test_texts_without_entities_stay(spark):
    texts = [None, "", " ", "plain text with 12 numbers 3.14 and e.g. this", "Mr", "a@b", "word " * 5000, "日本語 ñ 12.5"]
    assert _one(spark, *texts) == [(t, 0) for t in texts]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pseudonymise(empty, "k").collect() == []
    long = ("lorem " * 2000 + "x@y.example.com ") * 5
    ((new, n),) = _one(spark, long)
    assert n == 5 and "x@y" not in new and len(set(re.findall(r"\S+@\S+", new))) == 1


def _brute_pii(text, draws):
    """Text and number of matches, straight from the description; ``draws``: (kind, canon) to surrogate."""
    import regex

    py = lambda p: p.replace(r"\d", "[0-9]").replace(r"\D", "[^0-9]").replace(r"[^\s", r"[^ \t\n\x0b\f\r").replace(r"\s", r"[ \t\n\x0b\f\r]").replace(r"\p{Is", r"\p{Script=")
    ending = regex.compile(r"(?:['’]s|['’\-]+)\Z")
    script = lambda w: next((s for s in ("cyrillic", "greek", "latin") if regex.search(rf"\p{{Script={s}}}", w)), "other")
    bare = lambda w: ending.sub("", w)
    shout = lambda w: len(w) > 1 and w.upper() == w
    form = lambda w, s: (s.upper() if shout(bare(w)) else s[:1].upper() + s[1:]) + w[len(bare(w)):]
    if not text:
        return text, 0
    found = []
    for m in regex.finditer(py(PII.PATTERN), text):
        kind = next(k for k, f in PII.FORMS.items() if regex.fullmatch(py(f), m[0]))
        head = regex.match(py(PII._TITLES), m[0])[0] if kind == "name" else ""
        found.append((m.start(), m.end(), kind, head, m[0][len(head):]))
    gender, ents = {}, []
    for _, _, kind, head, body in found:
        if kind != "name":
            continue
        titles = {t.rstrip(".") for t in head.split()}
        g = "given_f" if titles & set(PII.FEMALE_TITLES) else "given_m" if titles & set(PII.MALE_TITLES) else "given_n"
        ws = body.split(" ")
        for k, w in enumerate(ws):
            ents.append((("family" if k == len(ws) - 1 else g), bare(w).lower(), script(bare(w))))
            if k < len(ws) - 1 and g != "given_n":
                key = (bare(w).lower(), script(bare(w)))
                gender[key] = min(gender.get(key, g), g)
    told = lambda p, c, s: gender.get((c, s), p) if p == "given_n" else p
    words = {}
    for p, c, s in ents:
        kind = f"{told(p, c, s)}:{s}"
        if c not in words or kind < words[c]:
            words[c] = kind

    def rest(part):
        def one(m):
            w = m[0]
            if not regex.match(r"\p{Lu}", w):
                return w
            if w.lower() in words:
                s = draws[words[w.lower()], w.lower()]
                return s.upper() if w.upper() == w else s[:1].upper() + s[1:]
            c = bare(w).lower()
            return form(w, draws[words[c], c]) if c in words else w

        return regex.sub(r"[\p{L}\p{M}\p{N}]+(?:['’\-]+[\p{L}\p{M}\p{N}]+)*", one, part)

    out, at, named = [], 0, iter(ents)
    for a, b, kind, head, body in found:
        out.append(rest(text[at:a]))
        at, m = b, text[a:b]
        if kind == "name":
            new = [form(w, draws[f"{told(p, c, s)}:{s}", c]) for w, (p, c, s) in zip(body.split(" "), named)]
            out.append(head + " ".join(new))
        elif kind == "email":
            s = draws["email", m.lower()]
            out.append(s.upper() if m.upper() == m else s)
        elif kind in ("phone", "card", "ssn", "iban"):
            canon = m.replace(" ", "") if kind == "iban" else re.sub("[^0-9]", "", m)
            left = iter(draws[kind, canon])
            new = "".join(next(left, c) if re.match("[0-9A-Za-z]", c) else c for c in m)
            out.append(new + "".join(left))
        elif kind in ("secret", "hex"):
            key = regex.match(py(PII._SECRET_KEY), m)
            head = key[0] if key else ""
            plain = m[len(head):]
            hexed = re.fullmatch("[0-9a-f]+|[0-9A-F]+", plain)
            s = draws["secret", plain.lower() if hexed else plain]
            out.append(head + (s.upper() if hexed and plain.upper() == plain and plain.lower() != plain else s))
        else:
            out.append(draws[kind, m])
    return "".join(out) + rest(text[at:]), len(found)


NAMED = [
    "Mr John Smith called. Smith said John Smith will pay. Smith's car, SMITH, smith and Smithson stay or go.",
    "Dr. Anna Lee met Mrs. Anna Lee; Prof. Dr. Anna-Maria O'Brien saw Anna. O'Brien's, Lee’s and Lee-Young",
    "Dr. Kim Park wrote. Kim Park, KIM, kim.", "Herr Dr. Müller kam; MÜLLER und Müllers.", "Mr Paul Smith and Mrs Paul: Paul!",
    "доктор Иван Петров, Иван и Петров; господин Иван Сидоров", "Mr Smith's car and Mr JAMES' own. James",
    "pay 3782 822463 10005 or 3782-822463-10005", "Mr Smith\nSmith\t(Smith) Smith2 Smith_x token=Smith12345 Smith@mail.example.org",
    "Mr John Smith called. Smith said John Smith will pay. Smith's car, SMITH, smith and Smithson stay or go.", None, "", "Smith alone has no title.",
]


def test_whole_texts_equal_brute_force(spark):
    docs = [(i, t) for i, t in enumerate(NAMED)] + [(100, "Mr Ann Lee " * 400 + "and Ann " * 400)]
    docs += [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n) for r in pseudonymise(df, "k", count_col="n").collect()}
    assert len(got) == len(docs)
    # the surrogate table of all entities that the description finds
    asked = set()

    class Ask(dict):
        def __missing__(self, entity):
            asked.add(entity)
            return ""

    for _, t in docs:
        _brute_pii(t, Ask())
    table = spark.createDataFrame(sorted(asked), "kind string, canon string")
    draws = {(r.kind, r.canon): r.surrogate for r in surrogates(table, "k").collect()}
    for i, t in docs:
        assert got[i] == _brute_pii(t, draws), i


def test_mentions_without_a_title(spark):
    got = _one(spark, *[t for t in NAMED[:4]])
    first = re.fullmatch(r"Mr (\w+) (\w+) called\. (\w+) said (\w+) (\w+) will pay\. (\w+)'s car, ([A-Z]+), smith and Smithson stay or go\.", got[0][0])
    assert first and first[1] == first[4] != "John"
    assert first[2] == first[3] == first[5] == first[6] == first[7].capitalize() != "Smith"
    second = re.fullmatch(r"Dr\. (\w+) (\w+) met Mrs\. (\w+) (\w+); Prof\. Dr\. .*", got[1][0])
    assert second and second[1] == second[3] and second[2] == second[4] and "Anna" not in got[1][0]
    assert "Park" not in got[2][0] and "ller" not in got[3][0].replace("Müllers", "") and "Dr." in got[3][0]
    assert [n for _, n in got] == [1, 3, 1, 1]


def _links(texts):
    sets = [set(shingle_set(t, 5).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def test_pipeline_stage_by_stage(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [f.__name__ for _, f in P.STAGES] == ["quality", "near_duplicates", "pii", "mixing", "sentencepiece"]
    stages = [docs]
    for _, f in P.STAGES:
        out = f(spark, stages[-1], SF)
        stages.append(spark.createDataFrame(out.collect(), out.schema))
    for s in stages[1:5]:
        assert s.columns == docs.columns
    rows = [s.collect() for s in stages]
    ok = lambda t: not base_failed(Text(t)) and not any(r.rejects(Text(t)) for r in RULES)
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if ok(r.text)}
    order = sorted(rows[1], key=lambda r: r.doc_id)
    group = _links([r.text for r in order])
    low = {}
    for r, g in zip(order, group):
        low.setdefault(g, r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(low.values())
    private = re.compile(r"[\w.]+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b")
    hits = {m for r in rows[2] for m in private.findall(r.text)}
    after = " ".join(r.text for r in rows[3])
    assert hits and not [h for h in hits if h in after]
    before = {r.doc_id: r for r in rows[2]}
    for r in rows[3]:
        assert r.n_chars == len(r.text)
        if not private.search(before[r.doc_id].text) and "." in r.text:
            assert re.sub(r"\d", "", r.text)[:3] == re.sub(r"\d", "", before[r.doc_id].text)[:3]
    copies = Counter(r.doc_id for r in rows[4])
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows[3]}
    assert set(copies.values()) <= {1, 2} and abs(sum(size[d] * n for d, n in copies.items()) - 1.5 * sum(size.values())) < 0.05 * sum(size.values())
    texts = {r.doc_id: r.text for r in rows[4]}
    assert Counter(r.doc_id for r in rows[5]) == copies
    for r in rows[5]:
        assert r.ids == library.encode(texts[r.doc_id]) and r.decoded == library.decode(r.ids)


def test_run_equals_its_stages(spark):
    got = Counter((r.doc_id, r.ids_sha256) for r in P.run(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in P.STAGES:
        docs = f(spark, docs, SF)
    assert got == Counter((r.doc_id, r.ids_sha256) for r in docs.collect())


def test_pipeline_edge_rows(spark, library, tmp_path):
    word = lambda k: f"{'bcdfghjklm'[k % 10]}{'aeiou'[k % 5]}{'nprstvwz'[k % 8]}{'aeiou'[k // 7 % 5]}{'ln'[k % 2]}{'bcdfgh'[k // 3 % 6]}"
    text = lambda start, n: " ".join(word(k * k + start) for k in range(start, start + n)) + " done"
    long = text(5000, 20_000)
    rows = [
        (1, text(0, 40), "en", "a", 1, "x", 7), (1, text(0, 40), "en", "a", 1, "x", 7), (2, None, "en", "a", 0, None, 7), (3, "", None, None, 0, None, 7),
        (None, text(300, 40), None, None, 1, "y", None), (4, "Mr John Lee wrote: " + text(900, 40) + " Lee", "en", "b", 1, "z", 7), (5, long, "en", "b", 1, None, 7),
    ]
    ddl = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, kept int"
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/rows/documents.parquet")
    spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/none/documents.parquet")
    before = storage.written(spark)
    got = P.run(spark, f"{tmp_path}/rows").collect()
    assert storage.written(spark) == before + 1  # only the last table stays
    judged = P.quality(spark, spark.read.parquet(f"{tmp_path}/rows/documents.parquet"), "")
    kept = [r.text for r in judged.collect()]
    assert judged.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "kept"] and None not in kept and "" not in kept
    assert {r.doc_id for r in got} <= {r.doc_id for r in judged.collect()} and got
    assert "Mr John Lee" not in " ".join(r.decoded for r in got) and all(" Lee" not in r.decoded for r in got)
    assert all(r.ids == library.encode(r.decoded) for r in got)
    assert P.run(spark, f"{tmp_path}/none").collect() == []
