"""Token counts (operator 2): map-side two-tier lookup, no pre-token is shuffled.

Tier 1 is a compact table of frequent pre-tokens and their token lengths,
broadcast to every worker.  Tier 2 is a bounded cache in each Python worker that
encodes the pre-tokens the table misses.  Counts are exact whatever the tiers
hold: they only decide how often the encoder is called.

The table is fitted on a bounded sample: the first ``FIT_ROWS`` rows of at most
``FIT_PARTITIONS`` partitions, evenly spaced over the input.  Only these
partitions are started for it, each returns its most frequent pre-tokens
(``SENT_PER_TASK`` at most), and the driver sums them, so what it takes in does
not grow with the input.  All texts are then read once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from colline.llm.pieces import SPACE, REMEMBERED_LENGTH, Remembered, Segmenter, load_processor

TABLE_SIZE = 32_768  # pre-tokens in the broadcast table (at most 48 characters each: below 8 MB)
FIT_PARTITIONS = 16  # partitions that the table is fitted on, at most ...
FIT_ROWS = 256  # ... and rows of each of them
SENT_PER_TASK = 8_192  # pre-tokens that each of them returns, the most frequent ones

OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)
_WORKER: dict[str, object] = {}


def _once(key: str, make):
    """One value per Python worker and key: workers are reused by later tasks."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def segment_length(processor, segment: str) -> int:
    """Tokens of a segment.  A line end in front keeps the library's added space apart:
    these two make two tokens that never merge with what follows."""
    return len(processor.encode("\n" + segment.replace(SPACE, " "))) - 2


def frequent_segments(docs: DataFrame, text_col: str, model, size: int = TABLE_SIZE) -> list[str]:
    """The most frequent segments of the fitting sample (``size`` at most), ties by text."""

    def count(rows: Iterator[Row]) -> list[tuple[str, int]]:
        segments = _once("segments", lambda: Segmenter(load_processor(model.value)))
        seen: Counter[str] = Counter()
        for row in islice(rows, FIT_ROWS):
            seen.update(segments(row[0]))
        return [(s, n) for s, n in seen.most_common(SENT_PER_TASK) if n > 1 and len(s) <= REMEMBERED_LENGTH]

    texts = docs.select(F.col(text_col).alias("text")).rdd
    parts = texts.getNumPartitions()
    picked = sorted({k * parts // FIT_PARTITIONS for k in range(FIT_PARTITIONS)}) if parts else []
    total: Counter[str] = Counter()
    for segment, n in docs.sparkSession.sparkContext.runJob(texts, count, picked) if picked else []:
        total[segment] += n
    return sorted(total, key=lambda s: (-total[s], s))[:size]


def token_counts(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per input row.

    Counts are those of the library's ``encode`` without begin or end ids.  A
    null or empty text has 0 bytes and 0 tokens; a null id stays null; repeated
    rows give repeated rows; other columns of ``docs`` are not read.  Texts are
    processed whole, segment by segment.  An empty table gives an empty result.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)  # the vocabulary file: fixed size
    words = frequent_segments(docs, text_col, shared, table_size)
    processor = load_processor(model)
    lengths = np.array([segment_length(processor, s) for s in words], dtype=np.uint16).tobytes()
    frequent = sc.broadcast((words, lengths))
    name = sha256(model + "\n".join(words).encode("utf-8")).hexdigest()  # of what the workers keep

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make():
            sp = load_processor(shared.value)
            keys, counts = frequent.value
            first = dict(zip(keys, np.frombuffer(counts, dtype=np.uint16).tolist()))
            return Segmenter(sp), Remembered(lambda s: segment_length(sp, s), first)

        segments, known = _once(name, make)
        length = known.__getitem__
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [sum(map(length, segments(t))) for t in texts]
            sizes = [len(t.encode("utf-8")) if t else 0 for t in texts]
            over = [n > limit for n in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())],
                schema=OUT,
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
