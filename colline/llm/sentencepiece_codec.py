"""SentencePiece encoding and decoding (operator 9) by the prefix table of :mod:`colline.llm.pieces`."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.llm.pieces import PrefixCodec, Remembered

# Documents whose ids are held at once.
ROWS = 128

_WORKER: dict[bytes, tuple[PrefixCodec, Remembered]] = {}


def _codec(model: bytes) -> tuple[PrefixCodec, Remembered]:
    """The worker's codec and its cache: segment -> (ids as text, number of ids, decoded text)."""
    key = sha256(model).digest()
    if key not in _WORKER:
        _WORKER.clear()
        codec = PrefixCodec(model)

        def make(segment: str):
            ids = codec.encode_segment(segment)
            return ",".join(map(str, ids)), len(ids), codec.decode_pieces(ids)

        _WORKER[key] = codec, Remembered(make)
    return _WORKER[key]


def encode_documents(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode and decode every whole text; one row per input row.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with ``with_ids``,
    ``ids`` (array of int) and ``decoded`` (text).  Ids and text are those of
    the library's ``encode`` and ``decode``, without begin or end ids.  A null
    or empty text has no ids and decodes to the empty text; a null id stays
    null; repeated rows give repeated rows; other columns are not read; an
    empty table gives an empty result.  Work and memory are linear in a text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the vocabulary file: fixed size
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        ddl += ", ids array<int>, decoded string"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known = _codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts, id_digests, text_digests, ids, decoded = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    segments = [known[s] for s in codec.segments(text)]
                    line = ",".join([s[0] for s in segments])
                    back = "".join([s[2] for s in segments])[1:]  # without the space that encoding added
                    counts.append(sum([s[1] for s in segments]))
                    id_digests.append(sha256(line.encode()).hexdigest())
                    text_digests.append(sha256(back.encode("utf-8")).hexdigest())
                    if with_ids:
                        ids.append(np.fromstring(line, dtype=np.int32, sep=",") if line else np.empty(0, np.int32))
                        decoded.append(back)
                arrays = [part.column(0), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(text_digests)]
                if with_ids:
                    ends = np.cumsum([0] + [len(i) for i in ids]).astype(np.int32)
                    arrays += [pa.ListArray.from_arrays(ends, np.concatenate(ids)), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, ddl)


def decode_documents(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from arrays of ids (null or empty: the empty text; null or unknown ids raise)."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, _ = _codec(shared.value)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
