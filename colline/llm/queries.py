"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from colline.llm.alignment import alignment_counts
from colline.llm.block_topk import top_k
from colline.llm.chat import chat_documents
from colline.llm.common import table
from colline.llm.jaccard_join import jaccard_components
from colline.llm.kneser_ney import classify
from colline.llm.minhash_dedup import near_duplicates
from colline.llm.mixing import Mix
from colline.llm.pii import pseudonymise
from colline.llm.quality_rules import MEASURES, quality_rules
from colline.llm.sentencepiece_codec import encode_documents
from colline.llm.token_counts import token_counts
from colline.llm.url_filters import judge_urls
from colline.llm.whitening import whitened_rows

# The key of the surrogates; a real run takes it from a secret store.
PII_KEY = "surrogate-key-1"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def piece_model() -> bytes:
    return vocabulary(PIECE_MODEL)


def op1_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(table(spark, sf_dir, "documents")).counts().select("doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), piece_model())


def op3_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_documents(table(spark, sf_dir, "conversations"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *MEASURES, "base_failed", "kept")


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return classify(table(spark, sf_dir, "documents"), trusted)


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op7_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY, count_col="n_entities")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), piece_model(), with_ids=False)


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2).select("doc_id", "n_shingles", "component_id", "kept")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), piece_model())


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_rows(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pareto_mixing, op2_token_counts, op3_chat_snapshots, op4_quality_rules, op5_kneser_ney, op6_url_templates,
        op7_block_topk, op8_pii_surrogates, op9_sentencepiece, op10_minhash_dedup, op11_alignment, op12_jaccard_join, op13_whitening,
    )
}

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_AZ = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP1 = f"""
WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM d GROUP BY source),
w AS (
  SELECT *, ([3, 1, 2])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS most FROM s
),
o AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER before_, 0) AS left_, sum(w) OVER after_ AS weights
  FROM w WINDOW before_ AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after_ AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
c AS (SELECT *, most * weights <= w * left_ AS capped FROM o),
f AS (SELECT left_, weights FROM c WHERE NOT capped ORDER BY most / w, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, n_docs, CASE WHEN capped THEN most ELSE w * (SELECT left_ FROM f) / (SELECT weights FROM f) END AS target FROM c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
q AS (SELECT *, target - copies * source_size AS want FROM p),
r AS (
  SELECT d.doc_id, d.size, q.*, ((('0x' || substr(md5('mix:' || d.doc_id), 1, 13))::BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u,
    CASE WHEN source_size > 0 THEN want / source_size ELSE 0 END AS share,
    CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, greatest(0.5::DOUBLE, d.size::DOUBLE / (source_size::DOUBLE / n_docs))) ELSE 1 END AS preference
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
),
k AS (SELECT *, CASE WHEN share > 0 THEN u / (1 - u) / (share / (1 - share) * preference) END AS rank_ FROM r),
x AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank_, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM k)
SELECT doc_id, size, source_size, target,
  (size * (copies + CASE WHEN share > 0 AND (run <= want OR (run - size <= want AND run - want < want - (run - size))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x
"""

_OP3 = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn) AS l FROM t GROUP BY conv_id),
k AS (
  SELECT min(conv_id) AS conv_id, l FROM c GROUP BY l
  HAVING NOT EXISTS (SELECT 1 FROM c AS b WHERE len(b.l) > len(c.l) AND b.l[1:len(c.l)] = c.l)
)
SELECT k.conv_id, (t.turn // 1024)::BIGINT AS part, len(any_value(k.l))::BIGINT AS n_turns,
  string_agg('<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10), '' ORDER BY t.turn) AS text
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY k.conv_id, t.turn // 1024
"""

_OP4 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
r AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g SEMI JOIN r USING (doc_id, g), (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (
  SELECT doc_id, t, w, l, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^\pL]+', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
    length(regexp_replace(t, '[^\p{{Ll}}]+', '', 'g')) AS small,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS cries,
    len(list_filter(list_zip(w[1:-2], w[2:]), lambda x: x[1] = x[2])) AS stutters
  FROM d LEFT JOIN c USING (doc_id)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (
    base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(l)
    OR 10 * letters < 4 * word_chars OR (capitals >= 20 AND capitals > small) OR 4 * cries > n_words
    OR (n_words >= 20 AND 4 * list_max(map_values(list_aggregate(w, 'histogram'))) > n_words) OR 10 * stutters > 3 * n_words
    OR (len(l) >= 3 AND 10 * len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) > 3 * len(l))
    OR (len(l) >= 3 AND 10 * len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) > 9 * len(l))
  ) AS kept
FROM b
"""

_OP7 = """
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (SELECT q.place, q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score FROM v AS q JOIN v ON q.place <> v.place WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_AZ)} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS x FROM d
),
n AS (SELECT doc_id, len(x)::BIGINT AS n FROM s),
e AS (SELECT s.doc_id, n.n, unnest(x) AS g FROM s JOIN n USING (doc_id)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
y AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a, b FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id,
  n.doc_id = least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS kept
FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

_OP12 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_AZ)} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS x FROM d
),
n AS (SELECT doc_id, len(x)::BIGINT AS n FROM s),
e AS (SELECT s.doc_id, n.n, unnest(x) AS g FROM s JOIN n USING (doc_id)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
y AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a, b FROM y UNION SELECT r.a, y.b FROM r JOIN y ON r.b = y.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id
FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

#: The others (library tokenizers, language models, templates and surrogates) are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_pareto_mixing": _OP1,
    "op3_chat_snapshots": _OP3,
    "op4_quality_rules": _OP4,
    "op7_block_topk": _OP7,
    "op10_minhash_dedup": _OP10,
    "op12_jaccard_join": _OP12,
}
