"""Scalar functions on text, URLs, hashes, JSON, arrays; arithmetic and geography."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions import maths as M
from siltstone.functions import text as X
from siltstone.functions.chunks import register_table_functions
from siltstone.functions.encoder import hashed_embedding
from siltstone.functions.sql import register_sql_functions
from siltstone.plans.documents import chunk_text
from siltstone.queries.common import DIM, vectors_sql
from siltstone.queries.registry import query, rounded

HASH = r"upper(sha256(lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))))"


@query("content_hash", f"SELECT doc_id, {HASH} AS content_hash FROM documents")
def content_hash(t):
    return t.documents.select("doc_id", X.content_hash("text").alias("content_hash"))


KEY = "coalesce(CAST({} AS VARCHAR), '_dbt_utils_surrogate_key_null_')"


@query("generate_surrogate_key", f"""SELECT doc_id, md5({KEY.format('doc_id')} || '-' || {KEY.format('quality')}) AS k,
  md5(CAST(doc_id AS VARCHAR) || '-' || coalesce(CAST(quality AS VARCHAR), '')) AS k_empty
FROM documents LEFT JOIN labels USING (doc_id)""")
def generate_surrogate_key(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return rows.select(
        "doc_id", X.surrogate_key(["doc_id", "quality"]).alias("k"),
        X.surrogate_key(["doc_id", "quality"], nulls_as_empty=True).alias("k_empty"),
    )


@query("md5", "SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR)) AS h FROM orders")
def md5(t):
    return t.orders.select("o_orderkey", X.md5_hex("o_custkey").alias("h"))


BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("get_url_host", f"""SELECT page_id, split_part(split_part(replace({BARE}, 'android-app://', ''), '/', 1), '?', 1) AS host FROM pages""")
def get_url_host(t):
    return t.pages.select("page_id", X.url_host("url").alias("host"))


@query("get_url_path", f"""SELECT page_id, split_part(right(bare, CAST(length(bare) - coalesce(nullif(strpos(bare, '/'), 0), strpos(bare, '?') - 1) AS INTEGER)), '?', 1) AS path
FROM (SELECT page_id, {BARE} AS bare FROM pages)""")
def get_url_path(t):
    return t.pages.select("page_id", X.url_path("url").alias("path"))


@query("get_url_parameter", """SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
  nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref FROM pages""")
def get_url_parameter(t):
    return t.pages.select("page_id", X.url_parameter("url", "page").alias("page"), X.url_parameter("url", "ref").alias("ref"))


DIGITS = "list_filter(range(1, length(url) + 1), lambda i: regexp_matches(substr(url, i, 1), '[0-9]'))"


@query("regexp_instr", f"""SELECT page_id, strpos(url, regexp_extract(url, '[a-z]+\\.example'))::INTEGER AS host_at,
  coalesce(list_filter({DIGITS}, lambda i: i >= 12)[2], 0)::INTEGER AS second_digit_at,
  strpos(lower(url), '/fr/')::INTEGER AS french_at FROM pages""")
def regexp_instr(t):
    return t.pages.select(
        "page_id", X.match_position("url", r"[a-z]+\.example").alias("host_at"),
        X.match_position("url", "[0-9]", position=12, occurrence=2).alias("second_digit_at"),
        X.match_position("url", "/FR/", flags="i").alias("french_at"),
    )


@query("regexp_like", """SELECT doc_id, regexp_matches(text, '[A-Z][a-z]+ed') AS has_past, regexp_matches(text, '[0-9]{3}') AS has_number FROM documents""")
def regexp_like(t):
    return t.documents.select(
        "doc_id", F.col("text").rlike("[A-Z][a-z]+ed").alias("has_past"), F.col("text").rlike("[0-9]{3}").alias("has_number")
    )


@query("word_count", "SELECT doc_id, len(string_split(text, ' '))::INTEGER AS words FROM documents")
def word_count(t):
    return t.documents.select("doc_id", X.word_count("text").alias("words"))


@query("chunk_text", """SELECT doc_id, i::INTEGER AS chunk_index, n AS total_chunks, doc_id || '-' || i AS chunk_id, md5(substr(text, (i - 1) * 1000 + 1, 1000)) AS piece
FROM (SELECT doc_id, text, n, unnest(range(1, n + 1)) AS i FROM
  (SELECT *, CAST(greatest(1, ceil(length(text) / 1000.0)) AS INTEGER) AS n FROM documents))""")
def chunk_text_query(t):
    rows = chunk_text(t.documents, 1000, key="doc_id", text="text")
    return rows.select("doc_id", "chunk_index", "total_chunks", "chunk_id", F.md5("chunk_content").alias("piece"))


@query("chunk_text_overlap", """SELECT doc_id, i::INTEGER AS chunk_index, md5(substr(text, (i - 1) * 900 + 1, 1000)) AS piece
FROM (SELECT doc_id, text, unnest(range(1, n + 1)) AS i FROM
  (SELECT *, CAST(greatest(1, ceil((length(text) - 100) / 900.0)) AS INTEGER) AS n FROM documents))""")
def chunk_text_overlap(t):
    rows = chunk_text(t.documents, 1000, 100, key="doc_id", text="text")
    return rows.select("doc_id", "chunk_index", F.md5("chunk_content").alias("piece"))


@query("chunk_text_udtf", """SELECT doc_id::VARCHAR AS id, i::INTEGER AS chunk_index, n AS total_chunks, doc_id || '-' || i AS chunk_id, md5(substr(text, (i - 1) * 900 + 1, 1000)) AS piece
FROM (SELECT doc_id, text, n, unnest(range(1, n + 1)) AS i FROM
  (SELECT *, CAST(greatest(1, ceil((length(text) - 100) / 900.0)) AS INTEGER) AS n FROM documents))""")
def chunk_text_udtf(t):
    register_table_functions(t.spark)
    t.documents.selectExpr("string(doc_id) as id", "text as content", "lang").createOrReplaceTempView("texts_to_chunk")
    return t.spark.sql("""
        SELECT id, chunk_index, total_chunks, chunk_id, md5(chunk_content) AS piece
        FROM overlapping_chunks(1000, 100, TABLE(SELECT id, content, lang FROM texts_to_chunk))""")


@query("length", "SELECT doc_id, length(text) AS chars FROM documents")
def length(t):
    return t.documents.select("doc_id", F.length("text").alias("chars"))


@query("left", "SELECT doc_id, left(text, 12) AS head FROM documents")
def left(t):
    return t.documents.select("doc_id", F.left("text", F.lit(12)).alias("head"))


@query("substr", "SELECT doc_id, substr(text, 5, 7) AS mid FROM documents")
def substr(t):
    return t.documents.select("doc_id", F.substring("text", 5, 7).alias("mid"))


@query("concat", "SELECT doc_id, lang || ':' || source AS tag FROM documents")
def concat(t):
    return t.documents.select("doc_id", F.concat("lang", F.lit(":"), "source").alias("tag"))


@query("sql_functions", f"""SELECT doc_id, {HASH} AS content_hash, len(string_split(text, ' '))::INTEGER AS words,
  n_chars::DOUBLE / nullif(quality, 0) AS share FROM documents LEFT JOIN labels USING (doc_id)""")
def sql_functions(t):
    """The functions called from SQL text."""
    register_sql_functions(t.spark)
    rows = t.documents.join(t.labels, "doc_id", "left")
    return rows.selectExpr(
        "doc_id", "content_hash(text) as content_hash", "word_count(text) as words", "safe_divide(n_chars, quality) as share"
    )


PROPS = "CASE WHEN event_type = 'error' THEN 'oops ' || props WHEN event_type <> 'click' THEN props END"


def _props(t):
    broken = F.concat(F.lit("oops "), F.col("props"))
    value = F.when(F.col("event_type") == "error", broken).when(F.col("event_type") != "click", F.col("props"))
    return t.events.select("event_id", value.alias("v"))


@query("parse_metadata", f"""SELECT event_id, CASE WHEN json_valid(v) THEN json_extract_string(v, '$.k') END AS k,
  CASE WHEN NOT json_valid(v) THEN v END AS raw, v IS NULL AS absent FROM (SELECT event_id, {PROPS} AS v FROM events)""")
def parse_metadata(t):
    parsed = _props(t).select("event_id", X.parse_metadata("v").alias("m"))
    return parsed.select(
        "event_id", F.try_element_at("m", F.lit("k")).alias("k"), F.try_element_at("m", F.lit("raw")).alias("raw"),
        F.col("m").isNull().alias("absent"),
    )


@query("metadata_normalise", f"""SELECT event_id, CASE WHEN v IS NULL THEN '{{}}' WHEN json_valid(v) THEN v
  ELSE CAST(json_object('raw', v) AS VARCHAR) END AS m FROM (SELECT event_id, {PROPS} AS v FROM events)""")
def metadata_normalise(t):
    return _props(t).select("event_id", X.normalise_metadata("v").alias("m"))


@query("json_to_vector", "SELECT vec_id, len(embedding)::INTEGER AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM embeddings")
def json_to_vector(t):
    vectors = t.embeddings.select("vec_id", X.json_to_vector(F.to_json("embedding")).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rounded(vectors.select("vec_id", F.size("v").alias("dim"), total.alias("total")), 6, "total")


@query("array_ops", """SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], list_reverse(embedding::DOUBLE[])), 6) AS folded,
  len(embedding)::INTEGER AS n, list_sum(range(1, len(embedding) + 1))::BIGINT AS places FROM embeddings""")
def array_ops(t):
    v = F.col("embedding")
    products = F.zip_with(v, F.reverse(v), lambda a, b: a.cast("double") * b.cast("double"))
    places = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.size(v).cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = t.embeddings.select(
        "vec_id", F.aggregate(products, F.lit(0.0), lambda s, x: s + x).alias("folded"),
        F.size(v).alias("n"), places.alias("places"),
    )
    return rounded(rows, 6, "folded")


@query("embed_text", f"WITH {vectors_sql('d', 'documents', 'doc_id', 'text')} SELECT doc_id, bucket, w FROM d")
def embed_text(t):
    vectors = t.documents.select("doc_id", hashed_embedding("text", DIM).alias("v"))
    return vectors.select("doc_id", F.posexplode("v").alias("bucket", "w")).where("w <> 0")


@query("haversine_distance", """SELECT c_custkey, round(mi, 6) AS mi, round(mi * 1.60934, 6) AS km FROM (
  SELECT c_custkey, 2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat1) / 2)), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2))) AS mi
  FROM (SELECT c_custkey, c_acctbal / 120 AS lat1, c_acctbal / 60 AS lon1,
          (c_nationkey * 3 - 30)::DOUBLE AS lat2, (c_nationkey * 7 - 90)::DOUBLE AS lon2 FROM customer))""")
def haversine_distance(t):
    points = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 120).alias("lat1"), (F.col("c_acctbal") / 60).alias("lon1"),
        (F.col("c_nationkey") * 3 - 30).cast("double").alias("lat2"),
        (F.col("c_nationkey") * 7 - 90).cast("double").alias("lon2"),
    )
    corners = ("lat1", "lon1", "lat2", "lon2")
    rows = points.select("c_custkey", M.haversine(*corners).alias("mi"), M.haversine(*corners, unit="km").alias("km"))
    return rounded(rows, 6, "mi", "km")


def _marks(t):
    return t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")


MARKS = "documents LEFT JOIN labels USING (doc_id)"


@query("safe_add", f"SELECT doc_id, n_chars + coalesce(quality, 0) + coalesce(toxic, 0) AS total FROM {MARKS}")
def safe_add(t):
    return _marks(t).select("doc_id", M.safe_add(["n_chars", "quality", "toxic"]).alias("total"))


@query("safe_subtract", f"SELECT doc_id, coalesce(quality, 0) - n_chars - coalesce(toxic, 0) AS rest FROM {MARKS}")
def safe_subtract(t):
    return _marks(t).select("doc_id", M.safe_subtract(["quality", "n_chars", "toxic"]).alias("rest"))


@query("safe_divide", f"SELECT doc_id, n_chars::DOUBLE / nullif(quality, 0) AS share FROM {MARKS}")
def safe_divide(t):
    return _marks(t).select("doc_id", M.safe_divide("n_chars", "quality").alias("share"))


@query("width_bucket", """SELECT p_partkey, (CASE WHEN p_retailprice < 920 THEN 0 WHEN p_retailprice >= 1020 THEN 11
  ELSE floor((p_retailprice - 920) / 100.0 * 10) + 1 END)::BIGINT AS bucket FROM part""")
def width_bucket(t):
    return t.part.select("p_partkey", M.width_bucket("p_retailprice", 920.0, 1020.0, 10).alias("bucket"))


@query("log_natural", """SELECT l_orderkey, l_linenumber, l_partkey, round(ln(nullif(l_discount, 0)), 6) AS log_discount FROM lineitem""")
def log_natural(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", M.log_natural("l_discount").alias("log_discount"))
    return rounded(rows, 6, "log_discount")


@query("rand", "SELECT o_orderstatus, count(*) AS n, true AS inside, true AS spread FROM orders GROUP BY ALL")
def rand(t):
    drawn = t.orders.withColumn("r", M.uniform(11))
    return drawn.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and((F.col("r") >= 0) & (F.col("r") < 1)).alias("inside"),
        (F.abs(F.avg("r") - 0.5) < 0.1).alias("spread"),
    )
