"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ringtrail.llm import (
    byte_bpe, embedding_dedup, exact_dedup, html_text, language_id, lexical_search, lm_scoring, mixing, nearest,
    resampling, simhash, token_files, warc,
)
from ringtrail.llm.common import prepare, staging, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return lm_scoring.score(table(spark, sf_dir, "documents"), staging(spark), ranks, public_tokenizers.PATTERN)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_round_trip(table(spark, sf_dir, "documents"), staging(spark), tokenizer)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), staging(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), staging(spark))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), staging(spark))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), staging(spark))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), staging(spark))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, staging(spark))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target, staging(spark))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), staging(spark))


OP3_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, whole GROUP BY term, docs),
impacts AS (
  SELECT tf.doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)) AS x
  FROM tf JOIN lengths ON lengths.doc_id = tf.doc_id, whole),
scored AS (
  SELECT item_id, doc_id, sum(w * x)::BIGINT AS score
  FROM q JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER g)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 WINDOW g AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 10
"""

OP12_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
w AS (SELECT doc_id, unnest(words) AS word FROM d),
seen AS (SELECT word FROM w UNION SELECT word FROM b),
bytes AS (SELECT word, hex(encode(word)) AS x FROM seen),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
      lambda k: ('0x' || substr(x, 2 * k + 1, 2))::BIGINT)),
    lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM bytes, crc),
dw AS (SELECT doc_id, bucket FROM w JOIN hashed USING (word)),
bw AS (SELECT bucket FROM b JOIN hashed USING (word)),
gains AS (
  SELECT g.bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000.0::DOUBLE)
    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000.0::DOUBLE))))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) g
    LEFT JOIN (SELECT bucket, count(*) AS s FROM dw GROUP BY bucket) USING (bucket)
    LEFT JOIN (SELECT bucket, count(*) AS t FROM bw GROUP BY bucket) USING (bucket)),
weights AS (
  SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS total FROM dw JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN weights USING (doc_id)),
final AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
placed AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place
  FROM final)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) FROM final WHERE n_features >= 20) * 10 // 100 THEN place END AS rank
FROM placed
"""


QUERIES = (
    op1_lm_scoring,
    op2_token_files,
    op3_exact_dedup,
    op4_language_id,
    op5_embedding_dedup,
    op6_simhash,
    op7_html_text,
    op8_byte_bpe,
    op9_mixing,
    op10_warc,
    op11_lexical_search,
    op12_resampling,
    op13_nearest,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op11_lexical_search": OP11_SQL, "op12_resampling": OP12_SQL}
