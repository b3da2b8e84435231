"""Quality classifier (operator 5): interpolated modified Kneser-Ney n-grams of characters.

Training.  The 4-grams of the trusted texts are counted for each language
(map-side first).  Lower orders count distinct left neighbours.  Discounts come
from the counts of counts of each language and order; interpolated
probabilities are built up order by order by joins of counts, context sums and
the order below.  The model is one table ``lang, len, gram -> p, gamma``: a
gram's probability after its context, and the weight of the lower order where
the gram is the context.

Scoring.  Documents are dealt into blocks of about 16 MB.  A block asks for the
distinct grams of its texts (all lengths up to 4); the questions of all blocks
are joined with the model, sharded by gram, and the answers go back to the
block, which scores its documents one by one.  So neither the model nor a
document's grams are gathered in one place, and texts move once.

Thresholds.  A fifth of the trusted texts (by a hash of the id) is kept out of
the training; a document is rejected if its perplexity exceeds its language's
quantile over these, times a margin.  A language without any of these takes the
quantile over its training texts.

A character is one of 4096 classes (its code point, from 3072 on folded into
1024 classes), so a gram is an exact 48-bit number: the context is its high
part, the shorter gram its low part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save, small_side

ORDER, BITS, CLASSES, FOLDED = 4, 12, 4096, 3072
BEFORE, AFTER = 2, 3  # classes that stand before and after a text
BLOCK_BYTES = 16 << 20
QUANTILE, MARGIN = 0.99, 1.15
HELD_OUT = 5  # every so many trusted ids sets thresholds instead of training; 0: none
FLUSH = 1 << 21  # grams that are sorted at once


def _mask(length: int) -> int:
    return (1 << (BITS * length)) - 1


def text_grams(text: str) -> np.ndarray:
    """The 4-grams of a whole text, one for each character and one for its end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    codes = np.where(codes < FOLDED, codes, FOLDED + codes % (CLASSES - FOLDED))
    line = np.concatenate([np.full(ORDER - 1, BEFORE), codes, [AFTER]])
    n = len(codes) + 1
    out = line[:n].copy()
    for k in range(1, ORDER):
        out = (out << BITS) | line[k : k + n]
    return out


class _Counts:
    """Distinct grams and their counts, merged in sorted runs."""

    def __init__(self):
        self.grams, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, grams: np.ndarray) -> None:
        self.waiting.append(grams)
        self.size += len(grams)
        if self.size >= FLUSH:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            grams, at = np.unique(np.concatenate([self.grams, new]), return_inverse=True)
            counts = np.zeros(len(grams), np.int64)
            np.add.at(counts, at[: len(self.grams)], self.counts)
            np.add.at(counts, at[len(self.grams) :], n)
            self.grams, self.counts, self.waiting, self.size = grams, counts, [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by: dict[str, _Counts] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if text:
                by.setdefault(lang, _Counts()).add(text_grams(text))
    for lang, c in by.items():
        c.flush()
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c.grams)), pa.array(c.grams), pa.array(c.counts)], names=["lang", "gram", "c"])


_PACKED = "block long, doc_id long, lang string, packed binary, th long"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, for the only time that they move."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = pa.array([compress(t.encode("utf-8")) for t in batch.column("packed").to_pylist()], pa.binary())
        yield batch.set_column(3, "packed", packed)


def _texts(packed: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    unpack = zstandard.ZstdDecompressor().decompress
    return (unpack(z).decode("utf-8") for z in packed.to_pylist())


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams of every length up to ORDER, by block and language."""
    by: dict[tuple[int, str], _Counts] = {}
    for batch in batches:
        for block, lang, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), _texts(batch.column(3))):
            by.setdefault((block, lang), _Counts()).add(text_grams(text))
    for (block, lang), c in by.items():
        c.flush()
        for length in range(ORDER + 1):
            grams = np.unique(c.grams & _mask(length))
            if 0 < length < ORDER:  # contexts, too
                grams = np.unique(np.concatenate([grams, c.grams >> (BITS * (ORDER - length)), *[
                    (c.grams & _mask(k)) >> (BITS * (k - length)) for k in range(length + 1, ORDER)
                ]]))
            n = len(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array([lang] * n), pa.array(np.full(n, length, np.int32)), pa.array(grams)],
                names=["block", "lang", "len", "gram"],
            )


def _log_probabilities(length: np.ndarray, gram: np.ndarray, p: np.ndarray, gamma: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Sorted ORDER-grams and their log probabilities from the answers of one block and language."""
    at = {k: np.flatnonzero(length == k) for k in range(ORDER + 1)}
    if not len(at[0]) or np.isnan(gamma[at[0]]).any():
        return None  # no trusted text in this language
    keys, probability, weight = {}, {}, {}
    for k in range(ORDER + 1):
        order = at[k][np.argsort(gram[at[k]])]
        keys[k], seen = gram[order], p[order]
        weight[k] = np.where(np.isnan(gamma[order]), 1.0, gamma[order])
        if k == 0:
            probability[0] = np.full(1, 1.0 / CLASSES)
            continue
        low = probability[k - 1][np.searchsorted(keys[k - 1], keys[k] & _mask(k - 1))]
        back = weight[k - 1][np.searchsorted(keys[k - 1], keys[k] >> BITS)]
        probability[k] = np.where(np.isnan(seen), back * low, seen)
    return keys[ORDER], np.log(probability[ORDER])


_SCORED = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("lang", pa.string()), ("n_grams", pa.int64()), ("perplexity", pa.float64())])


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    langs = np.array(answers.column("lang").to_pylist(), dtype=object)
    columns = [answers.column(c).to_numpy() for c in ("len", "gram", "p", "gamma")]
    tables = {}
    for lang in set(langs):
        rows = np.flatnonzero(langs == lang)
        tables[lang] = _log_probabilities(*[c[rows] for c in columns])
    out: list[list] = [[], []]
    for lang, text in zip(docs.column("lang").to_pylist(), _texts(docs.column("packed"))):
        grams, known = text_grams(text), tables.get(lang)
        out[0].append(len(grams))
        out[1].append(float(np.exp(-known[1][np.searchsorted(known[0], grams)].mean())) if known else None)
    return pa.Table.from_arrays(
        [docs.column("doc_id"), docs.column("th"), docs.column("lang"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.float64())], schema=_SCORED
    )


def gram_counts(trusted: DataFrame) -> dict[int, DataFrame]:
    """By length: ``lang, gram, c``, raw counts for the highest order, distinct left neighbours below."""
    top = trusted.mapInArrow(_count, "lang string, gram long, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    out = {ORDER: save(top, "kn-counts")}
    for length in range(ORDER - 1, 0, -1):
        low = out[length + 1].select("lang", F.col("gram").bitwiseAND(F.lit(_mask(length))).alias("gram"))
        out[length] = save(low.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("c")), "kn-counts")
    return out


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: modified Kneser-Ney discounts from the counts of counts (0.5, 1, 1.5 where those are 0)."""
    n = [F.count(F.when(F.col("c") == k, F.lit(1))).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    by = counts.groupBy("lang").agg(*n)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = []
    for k in (1, 2, 3):
        value = F.when(
            (F.col("n1") > 0) & (F.col(f"n{k}") > 0), F.lit(float(k)) - F.lit(k + 1.0) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        ).otherwise(F.lit(k / 2.0))
        d.append(F.greatest(F.lit(0.05 * k), F.least(F.lit(0.95 * k), value)).alias(f"d{k}"))
    return by.select(F.col("lang").alias("_lang"), *d)


def model(counts: dict[int, DataFrame]) -> DataFrame:
    """``lang, len, gram, p, gamma`` for all grams seen in training, and the empty gram."""
    rows: list[DataFrame] = []
    below: DataFrame | None = None
    for length in range(1, ORDER + 1):
        d = small_side(save(_discounts(counts[length]), "kn-discounts"))  # a row for each language
        level = counts[length].join(d, F.col("lang") == F.col("_lang")).drop("_lang")
        cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        level = level.withColumn("cut", cut).withColumn("context", F.shiftright("gram", BITS))
        sums = level.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass"))
        sums = save(sums.select("lang", "context", "total", (F.col("mass") / F.col("total")).alias("gamma")), "kn-contexts")
        rows.append(sums.select("lang", F.lit(length - 1).alias("len"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("p"), "gamma"))
        own = level.join(sums, ["lang", "context"])
        if below is None:
            low = F.lit(1.0 / CLASSES)
        else:
            shorter = below.select(F.col("lang").alias("_l"), F.col("gram").alias("_g"), F.col("p").alias("low"))
            own = own.join(shorter, (F.col("lang") == F.col("_l")) & (F.col("gram").bitwiseAND(F.lit(_mask(length - 1))) == F.col("_g")))
            low = F.col("low")
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("gamma") * low
        below = save(own.select("lang", "gram", p.alias("p")), "kn-grams")
        rows.append(below.select("lang", F.lit(length).alias("len"), "gram", "p", F.lit(None).cast("double").alias("gamma")))
    union = rows[0]
    for r in rows[1:]:
        union = union.unionAll(r)
    return save(union.groupBy("lang", "len", "gram").agg(F.max("p").alias("p"), F.max("gamma").alias("gamma")), "kn-model")


def perplexities(docs: DataFrame, model_table: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, th, lang, n_grams, perplexity`` of every row; null where its language has no model."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    th = F.xxhash64(F.col(text_col))
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("bigint"), th), F.lit(blocks)).alias("block"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), text.alias("packed"), th.alias("th"),
    ).mapInArrow(_pack, _PACKED).repartition(blocks, "block")
    asked = rows.mapInArrow(_ask, "block long, lang string, len int, gram long")
    answers = asked.join(model_table, ["lang", "len", "gram"], "left").select("block", "lang", "len", "gram", "p", "gamma")
    answers = answers.repartition(blocks, "block")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score, "doc_id long, th long, lang string, n_grams long, perplexity double"
    )


def classify(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    quantile: float = QUANTILE, margin: float = MARGIN, held_out: int = HELD_OUT,
) -> DataFrame:
    """``doc_id, lang, n_grams, perplexity, threshold, kept``, one row per input row.

    ``trusted_ids``: one column, the ids whose texts train the model and set
    the thresholds (repeats and nulls do not matter).  A null language is a
    language of its own (empty string); a language without trusted text has no
    model, no perplexity and no threshold, and its documents are kept.  Null and
    empty texts have one gram, the end; they are scored like others.  Null ids
    stay null and are not trusted; repeated rows give repeated rows; other
    columns are not read; an empty table gives an empty result.
    """
    ids = save(trusted_ids.select(F.col(trusted_ids.columns[0]).cast("bigint").alias("_trusted")).where("_trusted is not null").distinct(), "kn-trusted")
    apart = (F.pmod(F.xxhash64("_trusted"), F.lit(held_out)) == 0) if held_out else F.lit(False)
    trusted = docs.join(small_side(ids.where(~apart)), F.col(id_col).cast("bigint") == F.col("_trusted"), "left_semi")
    trusted = trusted.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    table = model(gram_counts(trusted))
    scored = save(perplexities(docs, table, id_col, text_col, lang_col), "kn-scored")
    known = scored.join(small_side(ids.select("_trusted", apart.alias("_apart"))), F.col("doc_id") == F.col("_trusted"))
    at = lambda c: F.percentile_approx(c, quantile, 10_000)
    limits = known.where("perplexity is not null").groupBy("lang").agg(
        (F.coalesce(at(F.when(F.col("_apart"), F.col("perplexity"))), at(F.col("perplexity"))) * F.lit(margin)).alias("threshold")
    )
    limits = small_side(save(limits.withColumnRenamed("lang", "_lang"), "kn-limits"))  # a row for each language
    out = scored.join(limits, F.col("lang") == F.col("_lang"), "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", "lang", "n_grams", "perplexity", "threshold", kept.alias("kept"))
