"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import project as P
from siltstone.operators.grams import build_postings, search_like, text_search_indexed, write_postings
from siltstone.operators.search import text_search
from siltstone.queries.common import GOLD, SCORE, SILVER, digest, gold, silver
from siltstone.queries.registry import query
from siltstone.session import scratch_path


@query("star", """SELECT c_name AS src_c_name_x, c_nationkey AS src_c_nationkey_x, c_acctbal AS src_c_acctbal_x
FROM customer""")
def star(t):
    return P.star(t.customer, ["C_CUSTKEY", "c_mktsegment"], "src_", "_x")


@query("filtered_columns", "SELECT p_partkey, p_name, p_size FROM part")
def filtered_columns(t):
    return t.part.select(P.filtered_columns(t.part, ["P_BRAND", "p_type", "p_retailprice"]))


@query("nullcheck", """SELECT doc_id, md5(nullif(replace(text, 'a', ''), '')) AS rest, source FROM documents""")
def nullcheck(t):
    rows = t.documents.select("doc_id", F.replace("text", F.lit("a"), F.lit("")).alias("rest"), "source")
    return P.nullcheck(rows, ["REST"]).withColumn("rest", F.md5("rest"))


@query("nullcheck_table", """SELECT nullif(l_returnflag, '') AS l_returnflag,
  nullif(replace(l_linestatus, 'O', ''), '') AS l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""")
def nullcheck_table(t):
    rows = t.lineitem.select("l_returnflag", F.regexp_replace("l_linestatus", "O", "").alias("l_linestatus"))
    return P.nullcheck(rows).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("filter_length_band", "SELECT doc_id, n_chars FROM documents WHERE length(text) BETWEEN 50 AND 10000")
def filter_length_band(t):
    return P.filter_length_band(t.documents, "text", 50, 10000).select("doc_id", "n_chars")


@query("filter_has_embedding", f"""WITH {GOLD}
SELECT id, CASE WHEN length(content) > 500 THEN 'present' ELSE 'needs embedding' END AS state FROM gold""")
def filter_has_embedding(t):
    rows = gold(t).withColumn(
        "embedding", F.when(F.length("content") > 500, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    )
    there = P.filter_has_embedding(rows).select("id", F.lit("present").alias("state"))
    return there.union(P.filter_has_embedding(rows, present=False).select("id", F.lit("needs embedding")))


@query("row_condition", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def row_condition(t):
    return P.row_condition(t.orders, "o_orderstatus = 'F' and o_totalprice > 200000").select("o_orderkey", "o_totalprice")


IGNORE = """WITH scored AS (SELECT doc_id, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
wide AS (SELECT doc_id, quality, CASE WHEN n_chars > 500 THEN toxic END AS toxic FROM scored)
SELECT doc_id, 'not all missing' AS rule FROM wide WHERE NOT (quality IS NULL AND toxic IS NULL)
UNION ALL SELECT doc_id, 'none missing' FROM wide WHERE NOT (quality IS NULL OR toxic IS NULL)"""


@query("ignore_row_if", IGNORE)
def ignore_row_if(t):
    wide = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left").withColumn(
        "toxic", F.when(F.col("n_chars") > 500, F.col("toxic"))
    )
    some = wide.where(P.keep_unless_missing("all_values_are_missing", ["quality", "toxic"]))
    full = wide.where(P.keep_unless_missing("any_value_is_missing", ["quality", "toxic"]))
    return some.select("doc_id", F.lit("not all missing").alias("rule")).union(full.select("doc_id", F.lit("none missing")))


@query("text_search", f"""WITH {SILVER}
SELECT id, md5(content) AS content_md5, 1.0::DOUBLE AS score FROM silver WHERE content ILIKE '%THE%' ORDER BY id LIMIT 25""")
def text_search_query(t):
    hits = text_search(silver(t), "THE", 25, columns=["content"])
    return hits.select("id", digest(), "score")


@query("text_search_indexed", f"""WITH {SILVER}
SELECT id, md5(content) AS content_md5, 1.0::DOUBLE AS score FROM silver WHERE content ILIKE '%que_é%' ORDER BY id""")
def text_search_by_grams(t):
    path, texts = scratch_path(t.spark, "grams"), silver(t)
    write_postings(build_postings(texts), path)
    hits = text_search_indexed(texts, t.spark.read.parquet(path), "que_é", None, columns=["content"])
    return hits.select("id", digest(), "score").orderBy("id")


@query("like_indexed", """SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%ring'""")
def like_indexed(t):
    path = scratch_path(t.spark, "grams")
    write_postings(build_postings(t.part, "p_partkey", "p_name"), path)
    names = t.part.select("p_partkey", "p_name")
    return search_like(names, t.spark.read.parquet(path), "small%ring", "p_partkey", "p_name", ignore_case=False)


@query("like_predicate", """SELECT p_partkey, p_name LIKE '%ring' AS is_ring, p_name NOT LIKE 'small%' AS not_small FROM part""")
def like_predicate(t):
    return t.part.select(
        "p_partkey", P.like_predicate("p_name", "%ring").alias("is_ring"),
        P.like_predicate("p_name", "small%", positive=False).alias("not_small"),
    )


@query("case_score", f"""SELECT doc_id, CAST(CAST({SCORE.format(c='text')} AS DECIMAL(4,1)) AS DOUBLE) AS quality_score FROM documents""")
def case_score(t):
    return t.documents.select("doc_id", P.quality_score("text").alias("quality_score"))
