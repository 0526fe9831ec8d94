"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from siltstone.llm.codes import ENTRIES, PARTS, ROUNDS, vector_codes
from siltstone.llm.exact_dedup import copy_groups
from siltstone.llm.fingerprints import fingerprints
from siltstone.llm.grid_join import COSINE, near_vectors
from siltstone.llm.negatives import NEGATIVES, POSITIVES, WINDOW, hard_negatives
from siltstone.llm.packing import pack
from siltstone.llm.perplexity import judged, trusted_ids
from siltstone.llm.pieces import round_trip
from siltstone.llm.pii import personal_data
from siltstone.llm.registry import ORACLES, QUERIES, query, table
from siltstone.llm.secrets import BASE, EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES, KINDS, LIVE_VARIETY, TOKEN, secret_report
from siltstone.llm.shards import shard_documents
from siltstone.llm.simhash import near_groups
from siltstone.llm.warc import archive_round_trip

# Where the public vocabularies lie, unless the caller says otherwise.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_best_fit_packing")
def op1(spark, folder):
    return pack(table(spark, folder, "documents"), WORD_TOKENIZER)


@query("op2_exact_dedup", """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM hashed""")
def op2(spark, folder):
    return copy_groups(table(spark, folder, "documents"))


@query("op3_quality_classifier")
def op3(spark, folder):
    found = judged(table(spark, folder, "documents"), trusted_ids(table(spark, folder, "labels")))
    return found.select("doc_id", "lang", "n_chars", "perplexity", "threshold", "kept")


def _hits_sql(kind: int, pattern: str, group: int) -> str:
    """Matches of a pattern in order with what stands before each, as in the operator."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, owner, {kind} AS kind, unnest(range(1, len(m) + 1)) AS pos, unnest(m) AS m, unnest(v) AS v, unnest(g[:len(m)]) AS g FROM (
  SELECT doc_id, owner, regexp_extract_all(t, '{quoted}', 0) AS m, regexp_extract_all(t, '{quoted}', {group}) AS v,
         string_split_regex(t, '{quoted}') AS g FROM docs) WHERE len(m) > 0"""


SECRETS_SQL = f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner FROM documents),
hits AS ({" UNION ALL ".join(_hits_sql(k, p, g) for k, (p, g, _) in enumerate([*BASE.values(), (TOKEN, 0, 20)]))}),
placed AS (
  SELECT doc_id, owner, kind, v AS value, length(m) AS n,
         sum(length(g) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY pos) AS e FROM hits),
spans AS (
  SELECT doc_id, owner, kind, value, CAST(e - n AS BIGINT) AS s, CAST(e AS BIGINT) AS e FROM placed
  WHERE length(value) >= CASE kind {" ".join(f"WHEN {k} THEN {least}" for k, (_, _, least) in enumerate(BASE.values()))} ELSE 20 END),
candidates AS (
  SELECT * FROM spans WHERE kind < {len(BASE)}
  UNION ALL SELECT * FROM spans c WHERE kind = {len(BASE)} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
    AND len(list_distinct(string_split(value, ''))) >= {LIVE_VARIETY}
    AND NOT EXISTS (SELECT 1 FROM spans b WHERE b.kind < {len(BASE)} AND b.doc_id = c.doc_id AND b.s < c.e AND b.e > c.s)),
counted AS (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, doc_id)) AS repositories FROM candidates GROUP BY ALL),
owners AS (SELECT *, owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES} * owners AS example FROM counted),
judged AS (SELECT c.*, example, owners, repositories, ['{"', '".join(KINDS)}'][kind + 1] || ':' || s || ':' || e AS shown
  FROM candidates c JOIN owners USING (value) WHERE kind < {len(BASE)} OR NOT example)
SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
  sha256(coalesce(string_agg(shown, ',' ORDER BY s, kind) FILTER (WHERE kind < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg(shown, ',' ORDER BY s, kind), '') AS spans,
  count(*) FILTER (WHERE kind = {len(BASE)}) AS n_owned, count(*) FILTER (WHERE example) AS n_example,
  coalesce(max(owners), 0) AS most_owners, coalesce(max(repositories), 0) AS most_repositories
FROM docs LEFT JOIN judged USING (doc_id) GROUP BY doc_id"""


@query("op4_secret_scan", SECRETS_SQL)
def op4(spark, folder):
    return secret_report(table(spark, folder, "documents"))


@query("op8_sharding")
def op8(spark, folder):
    return shard_documents(table(spark, folder, "documents"))


@query("op9_sentencepiece")
def op9(spark, folder):
    return round_trip(table(spark, folder, "documents"), PIECE_MODEL)


@query("op10_fingerprints")
def op10(spark, folder):
    return fingerprints(table(spark, folder, "documents"))


@query("op5_warc", """
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
bits AS (
  SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(digest, CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS parts FROM hashed),
shown AS (
  SELECT *, list_aggregate(flatten(list_transform(parts, lambda p: list_transform([15, 10, 5, 0],
           lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (p >> s) % 32 + 1, 1)))), 'string_agg', '') AS payload_digest
  FROM bits),
placed AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM shown)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS digest_matches
FROM placed""")
def op5(spark, folder):
    return archive_round_trip(table(spark, folder, "pages"))


@query("op6_personal_data")
def op6(spark, folder):
    return personal_data(table(spark, folder, "documents"))


@query("op7_simhash_near_dedup")
def op7(spark, folder):
    return near_groups(table(spark, folder, "documents"))


# Rows of embeddings without nulls and with finite components only.
SOUND_SQL = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
NUMBERS_SQL = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE))"


@query("op11_hard_negatives", f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {NUMBERS_SQL} AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {SOUND_SQL}),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER found AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND {WINDOW[0]} * positive_score <= 100 * score AND 100 * score <= {WINDOW[1]} * positive_score
WINDOW found AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER found <= {NEGATIVES}""")
def op11(spark, folder):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings").withColumn("label", moved), "vec_id % 100 = 0")


def _codes_sql() -> str:
    """The rounds one after another: nearest entries, then means, unused entries as they were."""
    steps = [f"""rows AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS place, * FROM (
    SELECT vec_id, label, list_transform({NUMBERS_SQL}, lambda x: CAST(x AS BIGINT)) AS v FROM embeddings WHERE {SOUND_SQL})),
parts AS (
  SELECT place, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x
  FROM rows, (SELECT unnest(range({PARTS})) AS part)),
books0 AS (SELECT part, place - 1 AS entry, x AS e FROM parts WHERE place <= {ENTRIES})"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""found{k} AS (
  SELECT place, part, x, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), entry := entry)) AS best
  FROM parts JOIN books{k} USING (part) GROUP BY ALL)""")
        if k < ROUNDS:
            steps.append(f"""means{k} AS (
  SELECT part, entry, list(m ORDER BY spot) AS e FROM (
    SELECT part, best.entry AS entry, spot, CAST(floor(sum(x[spot]) / count(*)) AS BIGINT) AS m
    FROM found{k}, unnest(range(1, len(x) + 1)) AS u(spot) GROUP BY ALL) GROUP BY ALL),
books{k + 1} AS (SELECT part, entry, coalesce(m.e, b.e) AS e FROM books{k} b LEFT JOIN means{k} m USING (part, entry))""")
    return f"""WITH {", ".join(steps)},
coded AS (
  SELECT place, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM found{ROUNDS} GROUP BY place)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM books{ROUNDS}) AS codebooks_sha256
FROM coded JOIN rows USING (place)"""


@query("op12_vector_codes", _codes_sql())
def op12(spark, folder):
    return vector_codes(table(spark, folder, "embeddings"))


@query("op13_embedding_near_dedup", f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS place, vec_id, embedding::DOUBLE[] AS v,
         {SOUND_SQL} AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable FROM embeddings),
links AS (
  SELECT a.place AS a, b.place AS b FROM rows a JOIN rows b ON a.place <> b.place
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.v, b.v) >= {COSINE}),
reached AS (
  SELECT place AS a, place AS b FROM rows UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
least AS (SELECT a AS place, min(vec_id) AS component_id FROM reached JOIN rows ON rows.place = reached.b GROUP BY a),
counted AS (SELECT a AS place, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM rows JOIN least USING (place) LEFT JOIN counted USING (place)""")
def op13(spark, folder):
    return near_vectors(table(spark, folder, "embeddings"))


def load() -> tuple[dict, dict]:
    return QUERIES, ORACLES
