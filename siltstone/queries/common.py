"""SQL fragments and frames shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.encoder import EMBEDDING_DIM, hashed_embedding
from siltstone.plans.documents import gold_documents, silver_documents
from siltstone.queries.registry import ntz
from siltstone.sources.tables import Tables, bronze_from_documents

AS_OF = "2024-02-01 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"
DIM = EMBEDDING_DIM

BRONZE = """bronze AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, text AS content, source,
         TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS ingested_at,
         '{"lang":"' || lang || '","n_chars":' || n_chars || '}' AS raw_metadata
  FROM documents)"""

NEWEST = BRONZE + r""", hashed AS (
  SELECT *, upper(sha256(lower(regexp_replace(content, '^\s+|\s+$', '', 'g')))) AS content_hash FROM bronze),
newest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY ingested_at DESC, id DESC) AS rn FROM hashed)
  WHERE rn = 1)"""

SILVER = NEWEST + f""", silver AS (
  SELECT id, content, content_hash, source, raw_metadata AS metadata,
         TIMESTAMP '{AS_OF}' AS processed_at, ingested_at
  FROM newest WHERE length(content) BETWEEN 50 AND 10000)"""

SCORE = r"""(CASE WHEN length({c}) > 200 THEN 0.3 WHEN length({c}) > 100 THEN 0.2 ELSE 0.1 END
  + CASE WHEN regexp_matches({c}, '[A-Z]') THEN 0.2 ELSE 0.0 END
  + CASE WHEN len(string_split({c}, ' ')) > 20 THEN 0.3 WHEN len(string_split({c}, ' ')) > 10 THEN 0.2 ELSE 0.1 END
  + CASE WHEN NOT regexp_matches({c}, '^\s*$') THEN 0.2 ELSE 0.0 END)"""

GOLD = SILVER + r""", pieces AS (
  SELECT *, CAST(greatest(1, ceil(length(content) / 1000.0)) AS INTEGER) AS total_chunks FROM silver),
chunks AS (
  SELECT *, unnest(range(1, total_chunks + 1)) AS chunk_index FROM pieces),
cut AS (
  SELECT id || '-' || chunk_index AS id, id AS doc, substr(content, (chunk_index - 1) * 1000 + 1, 1000) AS content,
         chunk_index, total_chunks, metadata, source, content_hash AS original_content_hash, ingested_at,
         length(content) AS original_length
  FROM chunks),
scored AS (
  SELECT *, CAST(""" + SCORE.format(c="content") + r""" AS DECIMAL(4,1)) AS quality_score
  FROM cut WHERE length(regexp_replace(content, '^\s+|\s+$', '', 'g')) > 0),
gold AS (
  SELECT * FROM scored WHERE quality_score >= 0.5)"""


def vectors_sql(name: str, rows: str, key: str, text: str, dim: int = DIM) -> str:
    """CTEs giving ``name``(key, bucket, w): the non-zero entries of the hashed vectors."""
    return rf"""{name}_words AS (
  SELECT {key}, unnest(string_split_regex(lower({text}), '\s+')) AS w FROM {rows}),
{name}_counts AS (
  SELECT {key}, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dim} AS INTEGER) AS bucket, count(*) AS c
  FROM {name}_words WHERE w <> '' GROUP BY ALL),
{name} AS (
  SELECT {key}, bucket, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS w
  FROM {name}_counts)"""


def bronze(t: Tables) -> DataFrame:
    return bronze_from_documents(t.documents)


def silver(t: Tables) -> DataFrame:
    return silver_documents(bronze(t), ntz(AS_OF))


def gold(t: Tables) -> DataFrame:
    return gold_documents(silver(t), ntz(AS_OF))


def hashed_text(df: DataFrame, column: str = "content", dim: int = DIM) -> DataFrame:
    return df.withColumn("embedding", hashed_embedding(column, dim))


def digest(column: str = "content"):
    return F.md5(column).alias("content_md5")


def query_vector(t: Tables, vec_id: int = 7) -> list[float]:
    return t.embeddings.where(F.col("vec_id") == vec_id).first()["embedding"]


QUERY_SQL = "(SELECT embedding FROM embeddings WHERE vec_id = 7)"
COSINE = "round(list_cosine_similarity(embedding::DOUBLE[], {q}::DOUBLE[]), 12)"
