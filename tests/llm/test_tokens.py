"""Operators 2 and 9 against the sentencepiece library."""

from __future__ import annotations

import random
from hashlib import sha256

from colline.llm import token_counts as T
from colline.llm.pieces import PrefixCodec, Remembered, Segmenter, load_processor
from colline.llm.sentencepiece_codec import decode_documents, encode_documents

from .conftest import HARD_TEXTS


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_codec_equals_library_on_random_text(model, library):
    codec, rnd = PrefixCodec(model), random.Random(5)
    alphabet = "   ▁\n\tab.,!?-_²½1239éßñ中日ゼ🙂\x00→the of ing ation()==--"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(4000)]
    for t in texts + [t for t in HARD_TEXTS if t]:
        ids = library.encode(t)
        assert codec.encode(t) == ids, t
        assert codec.decode(ids) == library.decode(ids), t


def test_segments_never_cut_a_piece(model):
    seg = Segmenter(load_processor(model))
    assert all(seg.find(p) == [p] for p in seg.pieces)


def test_remembered_is_bounded_and_keeps_the_frequent():
    calls = []
    cache = Remembered(lambda s: calls.append(s) or len(s), {"the": 1}, most=3)
    assert [cache[s] for s in ("the", "a", "bb", "a", "ccc", "dddd", "eeeee", "a")] == [1, 1, 2, 1, 3, 4, 5, 1]
    assert len(cache) <= 4 and "the" in cache and "the" not in calls
    assert cache["x" * 1000] == 1000 and "x" * 1000 not in cache


def test_token_counts(spark, hard_docs, model, library):
    want = sorted(
        ((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "")), len(library.encode(r.text or "")) > 100) for r in hard_docs.collect()),
        key=repr,
    )
    for size in (0, 3, T.TABLE_SIZE):
        got = T.token_counts(hard_docs, model, limit=100, table_size=max(size, 1))
        assert _rows(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert T.token_counts(hard_docs.limit(0), model).collect() == []


def test_encode_and_decode_documents(spark, hard_docs, model, library):
    got = encode_documents(hard_docs, model)
    want = []
    for r in hard_docs.collect():
        ids = library.encode(r.text or "")
        text = library.decode(ids)
        want.append((r.doc_id, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest(), ids, text))
    assert _rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded") == sorted(want, key=repr)
    assert _rows(decode_documents(got, model), "doc_id", "text") == sorted(((w[0], w[5]) for w in want), key=repr)
    assert encode_documents(hard_docs.limit(0), model).collect() == []
