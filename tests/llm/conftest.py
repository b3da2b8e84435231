from __future__ import annotations

import public_tokenizers
import pytest

from colline.llm.queries import piece_model

# Texts that are hard on word, character and piece boundaries.
HARD_TEXTS = [
    None, "", " ", "\n", "   \n  ", "a", "  two  spaces ", "line\nline\nline", "tab\tand\x0bvt\x0cff\rcr", "nbsp word",
    "<s> </s> <unk> <0x0A>", "a▁b", "▁", "x\x00y", "ñ é ß 中文 日本語 🙂🙂", "½²³ 12.5e-7", "-" * 70, "=" * 33 + " " * 33,
    "word " * 400, "ab" * 3000, "…!?() [] {} // ++ --", "İstanbul ǅ ﬁ", "​zero​width",
]


@pytest.fixture(scope="session")
def model() -> bytes:
    return piece_model()


@pytest.fixture(scope="session")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="session")
def hard_docs(spark):
    rows = [(i, t) for i, t in enumerate(HARD_TEXTS)] + [(None, "null id"), (3, "\n"), (5, "a"), (5, "a")]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_tokens string, ids int")
