"""Cross-tokenizer alignment (operator 11): which tokens of two vocabularies share bytes.

Workers encode whole texts with a byte-level BPE (A) and a SentencePiece model
(B), turn tokens into byte spans and align a block of documents with two
``pandas.merge_asof`` calls keyed by document: the covering B token of every A
start, and the covering A token of every B start.  Two spans overlap exactly if
the later start lies in the other span, so the union of both directions is all
overlaps; ends that both sides share cut the tokens into groups.

Corpus counts without moving a link per document: a block (about 2 MB of text)
keeps its links as one row and names its distinct id pairs once, with the
number of its documents that hold them.  The sums by pair, and the highest sum
of each A id, are two aggregations; every block then gets the answers for its
own pairs by one join, and a last pass over the blocks adds them up per
document.  No table is broadcast, and a row has the size of a block.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save

BLOCK_BYTES = 2 << 20  # a block ends with the text that reaches this size
SPACE = "▁"
# A single space between two characters that are no white space by any Unicode version.  Side A's
# pattern always ends a pre-token before it and starts one with it, and no piece of side B goes on
# across it (checked when the model is loaded), so both encode what is between two cuts on its own.
WORD_CUT = re.compile("(?<=[^\\s\u180e\u200b]) (?=[^\\s\u180e\u200b])")
WORDS_REMEMBERED, WORD_LENGTH = 300_000, 64

_WORKER: dict[str, Encoders] = {}


def byte_letters() -> dict[str, int]:
    """The byte of every letter that byte-level vocabularies write: printable Latin-1 stands for
    itself, the other bytes in their order for the code points from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoders:
    """Both tokenizers and the bytes of their tokens; one per worker.

    Side A spells every text (its vocabulary has all bytes); side B does not
    where it normalises, for instance the space mark itself to a space.
    """

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        self.a = Tokenizer.from_str(a.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode("utf-8")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode("utf-8") for i, p in enumerate(pieces)
        ]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        text = lambda n, end: np.array([f"{i}{end}" for i in range(n)], dtype=object)
        self.a_inner, self.a_last = text(len(self.a_bytes), ","), text(len(self.a_bytes), "|")
        self.b_inner, self.b_last = text(len(pieces), ","), text(len(pieces), ";")
        if self.a.normalizer is not None or not set(letters) <= set(vocabulary):
            raise ValueError("side A is no byte-level vocabulary that spells every text")
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces that go on after a space: texts can't be cut into words")
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.odd: set[str] = set()  # words that side B does not spell

    def _learn(self, words: list[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Ids (32-bit integers as bytes) of a space and each word on both sides."""
        a = [x.ids for x in self.a.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]
        b = self.b.encode(words, num_threads=1, add_bos=False, add_eos=False)
        spell = self.b_bytes.__getitem__
        self.odd.update(w for w, y in zip(words, b) if b"".join(map(spell, y)) != b" " + w.encode("utf-8"))
        pack = lambda ids: array("i", ids).tobytes()
        return dict(zip(words, map(pack, a))), dict(zip(words, map(pack, b)))

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Token ids of both sides as bytes; none where the tokens do not spell a space and the text.

        Words (see :data:`WORD_CUT`) are encoded once while they are remembered.
        """
        words = [WORD_CUT.split(t) if t else [] for t in texts]
        if len(self.known_a) > WORDS_REMEMBERED:
            self.known_a.clear()
            self.known_b.clear()
            self.odd.clear()
        new = set(chain.from_iterable(words)).difference(self.known_a)
        short = [w for w in new if len(w) <= WORD_LENGTH]
        for known, found in zip((self.known_a, self.known_b), self._learn(short)):
            known.update(found)
        if len(short) == len(new):
            get_a, get_b = self.known_a.__getitem__, self.known_b.__getitem__
        else:
            long_a, long_b = self._learn([w for w in new if len(w) > WORD_LENGTH])
            get_a = lambda w: long_a[w] if w in long_a else self.known_a[w]
            get_b = lambda w: long_b[w] if w in long_b else self.known_b[w]
        if self.odd:
            words = [w if self.odd.isdisjoint(w) else [] for w in words]
        return [b"".join(map(get_a, w)) for w in words], [b"".join(map(get_b, w)) for w in words]


def encoders(a: bytes, b: bytes) -> Encoders:
    name = sha256(a + b).hexdigest()
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Encoders(a, b)
    return _WORKER[name]


def vocabulary_size(model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()


@dataclass
class Aligned:
    """The tokens of a block's documents one after the other, their spans, groups and links.

    ``a_cut`` and ``b_cut`` are each document's token ranges, ``a_end`` and
    ``b_end`` byte offsets in the block, ``a_shut`` and ``b_shut`` mark the
    tokens that end a group, and ``link_a``, ``link_b`` are the places of
    overlapping tokens.
    """

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_shut: np.ndarray
    b_shut: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _covering(starts: pd.DataFrame, tokens: pd.DataFrame) -> np.ndarray:
    """Place of the last of ``tokens`` that starts at or before each of ``starts`` in its document."""
    return pd.merge_asof(starts, tokens, on="start", by="doc")["place"].to_numpy(dtype=np.int64)


def align(e: Encoders, texts: list[str | None]) -> Aligned:
    """Align the tokens of some texts; both sides of a text spell the same bytes."""
    ids_a, ids_b = e.encode(texts)
    a_cut, b_cut = (np.cumsum([0, *map(len, ids)]) // 4 for ids in (ids_a, ids_b))
    a, b = (np.frombuffer(b"".join(ids), dtype=np.int32).astype(np.int64) for ids in (ids_a, ids_b))
    a_end, b_end = np.cumsum(e.a_sizes[a]), np.cumsum(e.b_sizes[b])
    a_start, b_start = a_end - e.a_sizes[a], b_end - e.b_sizes[b]
    numbers = np.arange(len(texts))
    side = lambda start, cut: pd.DataFrame({"start": start, "doc": np.repeat(numbers, np.diff(cut)), "place": np.arange(len(start))})
    left, right = side(a_start, a_cut), side(b_start, b_cut)
    over_a = _covering(left[["start", "doc"]], right)  # the B token over each A start
    over_b = _covering(right[["start", "doc"]], left)
    apart = a_start[over_b] != b_start if len(b) else np.empty(0, dtype=bool)  # equal starts are found from both sides
    link_a = np.concatenate((left["place"].to_numpy(), over_b[apart]))
    link_b = np.concatenate((over_a, right["place"].to_numpy()[apart]))
    return Aligned(a, b, a_cut, b_cut, a_end, b_end, np.isin(a_end, b_end), np.isin(b_end, a_end), link_a, link_b)


def group_texts(e: Encoders, x: Aligned) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document: the ids of each group, A before B; '' without tokens."""
    last_a, last_b = np.flatnonzero(x.a_shut), np.flatnonzero(x.b_shut)
    group_a, group_b = np.cumsum(x.a_shut) - x.a_shut, np.cumsum(x.b_shut) - x.b_shut
    out = np.empty(len(x.a_ids) + len(x.b_ids), dtype=object)
    before = np.concatenate(([0], last_b + 1))  # B tokens in the groups before
    out[np.arange(len(x.a_ids)) + before[group_a]] = np.where(x.a_shut, e.a_last[x.a_ids], e.a_inner[x.a_ids])
    if len(x.b_ids):
        out[np.arange(len(x.b_ids)) + last_a[group_b] + 1] = np.where(x.b_shut, e.b_last[x.b_ids], e.b_inner[x.b_ids])
    cut = x.a_cut + x.b_cut
    return ["".join(out[i:j].tolist())[:-1] for i, j in zip(cut, cut[1:])]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= BLOCK_BYTES:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


_LONGS, _INTS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string())
_BLOCK = pa.schema(
    [
        ("block", pa.int64()), ("doc_id", _LONGS), ("n_a", _LONGS), ("n_b", _LONGS), ("n_groups", _LONGS), ("n_links", _LONGS),
        ("groups_sha256", _STRINGS), ("pairs", _LONGS), ("held", _INTS), ("kinds", _INTS), ("pair_at", _INTS), ("times", _INTS),
    ]
)
_BLOCK_SQL = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, held array<int>, kinds array<int>, pair_at array<int>, times array<int>"
)


def _block_row(e: Encoders, block: int, ids: list[int | None], texts: list[str | None]) -> pa.RecordBatch:
    """One row: figures of each document, the block's distinct id pairs (``pairs``, and in how many
    of its documents: ``held``), and each document's pairs as places there, with repeats counted."""
    x = align(e, texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(x.a_cut))[x.link_a]
    width = len(e.b_bytes)
    pair = x.a_ids[x.link_a] * width + x.b_ids[x.link_b]
    key, times = np.unique(doc * (width * len(e.a_bytes)) + pair, return_counts=True)
    of_doc, of_pair = np.divmod(key, width * len(e.a_bytes))
    pairs, at, held = np.unique(of_pair, return_inverse=True, return_counts=True)
    shut = np.concatenate(([0], np.cumsum(x.a_shut)))
    count = lambda values: np.bincount(values, minlength=len(texts))
    digests = [sha256(t.encode()).hexdigest() if t else "" for t in group_texts(e, x)]
    columns = [
        ids, np.diff(x.a_cut), np.diff(x.b_cut), np.diff(shut[x.a_cut]), count(doc), digests, pairs, held, count(of_doc), at, times,
    ]
    arrays = [pa.array([block], pa.int64())]
    for field, values in zip(list(_BLOCK)[1:], columns):
        flat = pa.array(values, field.type.value_type)
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat).cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_BLOCK)


def alignment_counts(
    docs: DataFrame, a_json: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per input row.

    An id pair's count is the number of rows whose text links it; ``n_best`` are
    the links whose count is the highest of their A id (ties included),
    ``count_sum`` adds the counts over all links.  Null and empty texts and those
    whose tokens do not spell a space and the text have zeros and ''.  A null id
    stays null, repeated rows are rows of their own, other columns are not read,
    an empty table gives an empty result.  Texts are encoded whole.
    """
    sc = docs.sparkSession.sparkContext
    files = sc.broadcast((a_json, b_model))  # vocabulary files: fixed size

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoders(*files.value)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _blocks(texts):
                yield _block_row(e, (task << 32) + number, ids[i:j], texts[i:j])
                number += 1

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = save(rows.mapInArrow(link, _BLOCK_SQL), "align-blocks")
    width = vocabulary_size(b_model)
    asked = blocks.select("block", F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("block", "p.pairs", "p.held")
    totals = save(asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")), "align-pairs")
    a_id = F.call_function("div", F.col("pair"), F.lit(width).cast("bigint"))
    best = totals.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    rated = totals.withColumn("a_id", a_id).join(best, "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    rated = save(rated, "align-rated")
    answers = (
        asked.select("block", F.col("pairs").alias("pair")).join(rated, "pair")
        .groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pair", "n", "best"))).alias("x"))
        .select("block", F.col("x.n").alias("n"), F.col("x.best").alias("best"))
    )
    figures = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    schema = pa.schema([(c, pa.int64()) for c in [*figures, "n_best", "count_sum"]] + [("groups_sha256", pa.string())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].values for c in batch.schema.names if batch.column(c)[k].is_valid}
                out = [row[c] for c in figures]
                cut = np.concatenate(([0], np.cumsum(row["kinds"].to_numpy())))
                if "n" in row:
                    at, times = row["pair_at"].to_numpy(), row["times"].to_numpy().astype(np.int64)
                    best = row["best"].to_numpy(zero_copy_only=False).astype(np.int64)
                    for values in (best, row["n"].to_numpy()):
                        run = np.concatenate(([0], np.cumsum(values[at] * times)))
                        out.append(pa.array(np.diff(run[cut]), pa.int64()))
                else:  # a block without links
                    out += [pa.array(np.zeros(len(out[0]), dtype=np.int64))] * 2
                yield pa.RecordBatch.from_arrays([*out, row["groups_sha256"]], schema=schema)

    kept = blocks.select("block", *figures, "groups_sha256", "kinds", "pair_at", "times")
    return kept.join(answers, "block", "left").drop("block").mapInArrow(
        score, ", ".join(f"{c} long" for c in [*figures, "n_best", "count_sum"]) + ", groups_sha256 string"
    )


def alignments(docs: DataFrame, a_json: bytes, b_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself, one row per input row: ``doc_id, a_ids, a_ends, b_ids, b_ends, group_ends, links``.

    Ends are byte offsets in a space and the text, ``group_ends`` those that
    both sides share, ``links`` the places (from 0) of overlapping tokens.
    Texts without tokens (see :func:`alignment_counts`) have empty arrays.
    """
    files = docs.sparkSession.sparkContext.broadcast((a_json, b_model))
    sql = "doc_id long, a_ids array<int>, a_ends array<long>, b_ids array<int>, b_ends array<long>, group_ends array<long>, links array<struct<a:int,b:int>>"
    kinds = [pa.int64(), _INTS, _LONGS, _INTS, _LONGS, _LONGS, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
    names = ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "group_ends", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoders(*files.value)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _blocks(texts):
                x = align(e, texts[i:j])
                order = np.lexsort((x.link_b, x.link_a))
                la, lb = x.link_a[order], x.link_b[order]
                cut = np.searchsorted(la, x.a_cut)
                out = []
                for k in range(j - i):
                    a0, a1, b0, b1 = x.a_cut[k], x.a_cut[k + 1], x.b_cut[k], x.b_cut[k + 1]
                    base = x.a_end[a0 - 1] if a0 else 0
                    a_end = x.a_end[a0:a1] - base
                    places = zip((la[cut[k] : cut[k + 1]] - a0).tolist(), (lb[cut[k] : cut[k + 1]] - b0).tolist())
                    out.append((
                        ids[i + k], x.a_ids[a0:a1].tolist(), a_end.tolist(), x.b_ids[b0:b1].tolist(), (x.b_end[b0:b1] - base).tolist(),
                        a_end[x.a_shut[a0:a1]].tolist(), [{"a": p, "b": q} for p, q in places],
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, sql)
