"""The operators as queries over the benchmark tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import bpe, chat, collocations, exact_dedup, html_text, minhash, mixing, near_vectors, pii, quality, repair, secrets, token_files
from meterlake.llm.common import table
from meterlake.session import scratch_dir


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.linked_vectors(spark, table(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, table(spark, sf_dir, "documents")).drop("row")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_spans(spark, table(spark, sf_dir, "documents")).drop("found")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded(spark, table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotations(spark, table(spark, sf_dir, "conversations"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(spark, table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(spark, table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.filed_and_read(spark, table(spark, sf_dir, "documents"), scratch_dir(spark, "token-files"), tokenizer)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(spark, table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (op1_near_vectors, op2_exact_dedup, op3_quality, op4_pii, op5_bpe, op6_mixing, op7_chat, op8_minhash, op9_html, op10_secrets, op11_collocations, op12_token_files, op13_repair)
    return {query.__name__: query for query in each}


OP2 = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), groups AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM texts JOIN groups USING (t)
"""

OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text FROM conversations
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
), roles AS (
  SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), segments AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10) || text || '<|im_end|>' || chr(10) AS segment
  FROM roles
), placed AS (
  SELECT *, row_number() OVER w - 1 AS position, CAST(sum(length(segment)) OVER w AS BIGINT) AS "end" FROM segments
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, position, turn, speaker, role, segment, "end" - length(segment) AS start, "end", role = 'assistant' AS trained
FROM placed
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), spans AS (
  SELECT lang, w, i, k FROM lists, unnest(range(1, len(w) + 1)) AS starts(i), unnest([1, 2, 3, 4]) AS lengths(k) WHERE i + k - 1 <= len(w)
), phrases AS (
  SELECT lang, w[i : i + k - 1] AS p, count(*) AS f FROM spans GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM phrases c, unnest(range(1, len(c.p))) AS places(k)
  JOIN phrases x ON x.lang = c.lang AND x.p = c.p[1 : k]
  JOIN phrases y ON y.lang = c.lang AND y.p = c.p[k + 1 : len(c.p)]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT g.lang, g.p[i : i + k - 1] AS p, max(g.f) AS f
  FROM phrases g, unnest(range(1, len(g.p) + 1)) AS starts(i), unnest([2, 3]) AS lengths(k)
  WHERE k < len(g.p) AND i + k - 1 <= len(g.p)
  GROUP BY ALL
), kept AS (
  SELECT l.* FROM lowest l LEFT JOIN inner_phrases i ON i.lang = l.lang AND i.p = l.p AND 100 * i.f >= 80 * l.a WHERE i.f IS NULL
), named AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score FROM kept
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM named JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op7_chat": OP7, "op11_collocations": OP11}
