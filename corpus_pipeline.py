"""A training-data pipeline in five stages; each stage's result is written and reread by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``.  Stages work on all their predecessor
kept, whole tables and whole texts.  What a stage wrote for itself, and the table
it read, are deleted when its own table is written; only the last one stays.

Null, empty and very long texts, null ids, repeated rows and further columns of
any name are what the operators define them to be: a null or empty text fails the
base rule and goes in the first stage, of equal rows one stays in the second,
further columns stay as they are until the last, which returns ids and tokens.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colline.llm.minhash_dedup import deduplicated
from colline.llm.mixing import Mix
from colline.llm.pii import pseudonymise
from colline.llm.quality_rules import quality_rules
from colline.llm.queries import PII_KEY, piece_model
from colline.llm.sentencepiece_codec import encode_documents
from colline.sources.storage import new_path, release, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject (one pass, no shuffle)."""
    rest = [c for c in docs.columns if c != "doc_id"]
    judged = quality_rules(docs, keep=rest).where("kept")
    return judged.select("doc_id", *[F.col(f"_keep{k}").alias(c) for k, c in enumerate(rest)]).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies (five-word shingles, similarity 0.8)."""
    return deduplicated(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; ``n_chars`` follows the new text."""
    out = pseudonymise(docs, PII_KEY)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents to the sources' target weights."""
    return Mix(docs).apply(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of ids and decoded text."""
    return encode_documents(docs, piece_model())


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("PII", pii),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Words in windows, similarity classes, surrogates and token ids are beyond SQL; see tests/llm/test_pii_and_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other through tables in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        mark = written(spark) - bool(k)  # the table that this stage reads goes with its own
        out = stage(spark, docs, sf_dir)
        path = new_path(spark, f"pipeline-{k}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        release(spark, mark, keep=[path])
    return docs
