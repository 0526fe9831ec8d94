"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import aggregates as A
from siltstone.queries.common import AS_OF, GOLD, gold
from siltstone.queries.registry import query, rounded


@query("index_status", f"""WITH {GOLD} SELECT count(*) AS document_count, '{AS_OF}' AS last_updated FROM gold""")
def index_status(t):
    return A.index_status(gold(t), "ready_at")


@query("embedding_coverage", f"""WITH {GOLD}, c AS (
  SELECT count(*) AS total_documents, count(*) FILTER (WHERE total_chunks = 1) AS documents_with_embeddings FROM gold)
SELECT *, printf('%.1f%%', documents_with_embeddings * 100.0 / total_documents) AS embedding_coverage,
  CASE WHEN documents_with_embeddings > 0 THEN 'ready' ELSE 'no_embeddings' END AS status FROM c""")
def embedding_coverage(t):
    rows = gold(t).withColumn("embedding", F.when(F.col("total_chunks") == 1, F.array(F.lit(1.0).cast("float"))))
    return A.embedding_coverage(rows)


@query("column_values", """SELECT source AS value, count(*) AS n FROM documents WHERE n_chars > 200
GROUP BY ALL ORDER BY n DESC, value LIMIT 12""")
def column_values(t):
    return A.column_values(t.documents, "source", 12, "n_chars > 200")


@query("pivot", """SELECT o_orderstatus,
  sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::BIGINT AS "p_1-URGENT",
  sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END)::BIGINT AS "p_5-LOW" FROM orders GROUP BY ALL""")
def pivot(t):
    return A.pivot(t.orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "5-LOW"], prefix="p_")


@query("pivot_then_value", """SELECT l_linestatus,
  round(sum(CASE WHEN l_quantity >= 10 THEN l_extendedprice ELSE 0 END), 2) AS at_least_10,
  round(sum(CASE WHEN l_quantity >= 30 THEN l_extendedprice ELSE 0 END), 2) AS at_least_30 FROM lineitem GROUP BY ALL""")
def pivot_then_value(t):
    wide = A.pivot(
        t.lineitem, ["l_linestatus"], "l_quantity", [10, 30], cmp=">=", prefix="at least ",
        then_value="l_extendedprice", slugify=True,
    )
    return rounded(wide, 2, "at_least_10", "at_least_30")


@query("count_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS distinct_count FROM orders GROUP BY ALL")
def count_distinct(t):
    return A.count_distinct_by(t.orders, "o_custkey", ["o_orderpriority"])


@query("proportion_unique", """SELECT event_type, round(count(DISTINCT user_id)::DOUBLE / count(user_id), 9) AS proportion_unique
FROM events GROUP BY ALL""")
def proportion_unique(t):
    return rounded(A.proportion_unique(t.events, "user_id", ["event_type"]), 9, "proportion_unique")


@query("agg_min_max_sum_avg", """SELECT l_returnflag, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value,
  round(sum(l_extendedprice), 2) AS sum_value, round(avg(l_extendedprice), 6) AS avg_value FROM lineitem GROUP BY ALL""")
def agg_min_max_sum_avg(t):
    found = A.profile(t.lineitem, "l_extendedprice", ["l_returnflag"])
    return rounded(rounded(found, 2, "sum_value"), 6, "avg_value")


@query("stddev", "SELECT c_mktsegment, round(stddev_samp(c_acctbal), 6) AS stddev_value FROM customer GROUP BY ALL")
def stddev(t):
    return rounded(A.stddev(t.customer, "c_acctbal", ["c_mktsegment"]), 6, "stddev_value")


@query("percentile_cont", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS q5,
  round(quantile_cont(l_extendedprice, 0.37), 6) AS q37, round(quantile_cont(l_extendedprice, 0.95), 6) AS q95
FROM lineitem GROUP BY ALL""")
def percentile_cont(t):
    found = A.percentile_cont(t.lineitem, "l_extendedprice", [0.05, 0.37, 0.95], ["l_returnflag"])
    return rounded(found, 6, "q5", "q37", "q95")


@query("median", "SELECT round(median(value), 6) AS median_value FROM events")
def median(t):
    return rounded(A.median(t.events, "value"), 6, "median_value")


@query("having_filter", """SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY ALL HAVING count(*) > 15""")
def having_filter(t):
    return A.having(t.orders, ["o_custkey"], F.count(F.lit(1)), "n_records", "n_records > 15")


@query("group_by", """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
FROM lineitem GROUP BY 1, 2""")
def group_by(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return A.group_by_first(rows, 2, F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("scalar_value", """SELECT (SELECT max(o_totalprice) FROM orders) AS highest,
  coalesce((SELECT o_totalprice FROM orders WHERE o_totalprice < 0 LIMIT 1), -1.0::DOUBLE) AS missing""")
def scalar_value(t):
    highest = A.scalar_value(t.orders.agg(F.max("o_totalprice")), name="highest")
    missing = A.scalar_value(t.orders.where("o_totalprice < 0").select("o_totalprice"), -1.0, "missing")
    return highest.join(F.broadcast(missing), how="inner")


@query("row_count", "SELECT lang, count(*) AS row_count FROM documents GROUP BY ALL")
def row_count(t):
    return A.row_count(t.documents, ["lang"])


@query("period_sum", """SELECT CAST(CAST(date_trunc('week', ts) AS TIMESTAMP) AS VARCHAR) AS period, event_type,
  round(sum(value), 4) AS period_value FROM events GROUP BY ALL""")
def period_sum(t):
    return rounded(A.period_sum(t.events, "ts", "week", "value", ["event_type"]), 4, "period_value")
