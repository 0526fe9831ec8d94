"""Checks of the core and generic families."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.checks import generic as G
from siltstone.checks import kept as P
from siltstone.checks import kernel as K
from siltstone.queries.common import BRONZE, GOLD, bronze, gold
from siltstone.queries.registry import ntz, query, rounded
from siltstone.session import scratch_path
from siltstone.sources import tables as S


def marked(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


MARKED = "(SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


@query("not_null", f"SELECT doc_id FROM {MARKED} WHERE quality IS NULL")
def not_null(t):
    return G.not_null(marked(t), "quality").select("doc_id")


@query("unique", "SELECT md5(text) AS unique_field, count(*) AS n_records FROM documents GROUP BY ALL HAVING count(*) > 1")
def unique(t):
    return G.unique(t.documents.select(F.md5("text").alias("h")), "h")


@query("accepted_values", """SELECT event_type AS value_field, count(*) AS n_records FROM events
WHERE event_type NOT IN ('click', 'error') GROUP BY ALL""")
def accepted_values(t):
    return G.accepted_values(t.events, "event_type", ["click", "error"])


@query("source_freshness", """SELECT CAST(max(ts) AS VARCHAR) AS max_loaded_at,
  datesub('hour', max(ts), TIMESTAMP '2024-02-01') AS age_hours, CASE WHEN datesub('hour', max(ts), TIMESTAMP '2024-02-01') > 48 THEN 'error'
  WHEN datesub('hour', max(ts), TIMESTAMP '2024-02-01') > 24 THEN 'warn' ELSE 'pass' END AS status FROM events""")
def source_freshness(t):
    return G.source_freshness(t.events, "ts", ntz("2024-02-01"))


@query("accepted_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice > 5000 OR NOT o_totalprice < 400000")
def accepted_range(t):
    return G.accepted_range(t.orders, "o_totalprice", 5000, 400000, inclusive=False).select("o_orderkey", "o_totalprice")


@query("at_least_one", f"""SELECT source, lang, 0::BIGINT AS filled FROM {MARKED} GROUP BY source, lang HAVING count(CASE WHEN toxic = 1 THEN 1 END) = 0""")
def at_least_one(t):
    rows = marked(t).withColumn("toxic", F.when(F.col("toxic") == 1, 1))
    return G.at_least_one(rows, "toxic", ["source", "lang"])


N = "(SELECT {a} AS nation, count(*) AS num_rows FROM {b} GROUP BY ALL)"
NA, NB = N.format(a="c_nationkey", b="customer"), N.format(a="s_nationkey", b="supplier")


@query("cardinality_equality", f"(SELECT * FROM {NA} EXCEPT SELECT * FROM {NB}) UNION ALL (SELECT * FROM {NB} EXCEPT SELECT * FROM {NA})")
def cardinality_equality(t):
    return G.cardinality_equality(t.customer.withColumnRenamed("c_nationkey", "nation"), "nation", t.supplier, "s_nationkey")


PAIR = """FROM (SELECT c_nationkey AS nation, count(*) AS n FROM customer WHERE c_acctbal > 8000 GROUP BY ALL) a
FULL JOIN (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY ALL) b ON a.nation = b.nation"""


def _pair(t):
    a = t.customer.where("c_acctbal > 8000").select(F.col("c_nationkey").alias("nation"))
    return a, t.supplier.select(F.col("s_nationkey").alias("nation"))


@query("equal_rowcount", f"SELECT coalesce(a.nation, b.nation) AS nation, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count {PAIR}")
def equal_rowcount(t):
    a, b = _pair(t)
    return G.equal_rowcount(a, b, ["nation"])


@query("fewer_rows_than", f"""SELECT coalesce(a.nation, b.nation) AS nation, a.n AS count_our_model, b.n AS count_comparison_model,
  CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta {PAIR}""")
def fewer_rows_than(t):
    a, b = _pair(t)
    return G.fewer_rows_than(a, b, ["nation"])


@query("equality", """SELECT 'a_minus_b' AS which_diff, * FROM (SELECT user_id, event_type FROM events WHERE value > 20 EXCEPT SELECT user_id, event_type FROM events WHERE value < 15)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT user_id, event_type FROM events WHERE value < 15 EXCEPT SELECT user_id, event_type FROM events WHERE value > 20)""")
def equality(t):
    return G.equality(t.events.where("value > 20"), t.events.where("value < 15"), ["user_id", "event_type"])


@query("expression_is_true", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_extendedprice * l_discount < 5000)")
def expression_is_true(t):
    return G.expression_is_true(t.lineitem, "* l_discount < 5000", "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey")


RANGES = """SELECT l_suppkey, lower_bound, upper_bound, next_lower_bound, is_last_record FROM (
  SELECT l_suppkey, l_orderkey AS lower_bound, l_orderkey + l_linenumber - 1 AS upper_bound,
    lead(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_orderkey + l_linenumber) AS next_lower_bound,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_orderkey + l_linenumber DESC) = 1 AS is_last_record FROM lineitem)
WHERE NOT (coalesce(lower_bound < upper_bound, false) AND coalesce(upper_bound {rule} next_lower_bound, is_last_record, false))"""


def _ranges(t):
    return t.lineitem.withColumn("high", F.col("l_orderkey") + F.col("l_linenumber") - 1)


@query("mutually_exclusive_ranges", RANGES.format(rule="<="))
def mutually_exclusive_ranges(t):
    return G.mutually_exclusive_ranges(_ranges(t), "l_orderkey", "high", ["l_suppkey"])


@query("mutually_exclusive_ranges_with_gaps", RANGES.format(rule="<"))
def mutually_exclusive_ranges_with_gaps(t):
    return G.mutually_exclusive_ranges(_ranges(t), "l_orderkey", "high", ["l_suppkey"], gaps="required")


@query("not_accepted_values", "SELECT DISTINCT p_brand AS value_field FROM part WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#99')")
def not_accepted_values(t):
    return G.not_accepted_values(t.part, "p_brand", ["Brand#2", "Brand#17", "Brand#99"])


@query("not_constant", "SELECT s_nationkey, count(DISTINCT s_acctbal > 0) AS distinct_values FROM supplier GROUP BY ALL HAVING count(DISTINCT s_acctbal > 0) = 1")
def not_constant(t):
    return G.not_constant(t.supplier.withColumn("credit", F.col("s_acctbal") > 0), "credit", ["s_nationkey"])


@query("not_empty_string", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE trim(replace(l_linestatus, 'O', ' ')) = ''")
def not_empty_string(t):
    rows = t.lineitem.withColumn("status", F.regexp_replace("l_linestatus", "O", " "))
    return G.not_empty_string(rows, "status").select("l_orderkey", "l_linenumber", "l_partkey")


@query("not_null_proportion", f"""SELECT source, round(count(quality)::DOUBLE / count(*), 9) AS not_null_proportion FROM {MARKED}
GROUP BY ALL HAVING count(quality)::DOUBLE / count(*) < 0.4 OR count(quality)::DOUBLE / count(*) > 0.45""")
def not_null_proportion(t):
    return rounded(G.not_null_proportion(marked(t), "quality", 0.4, 0.45, ["source"]), 9, "not_null_proportion")


@query("recency", """SELECT user_id, CAST(max(ts) AS VARCHAR) AS most_recent, '2024-01-30 20:00:00' AS threshold FROM events GROUP BY ALL
HAVING max(ts) < TIMESTAMP '2024-01-30 20:00:00'""")
def recency(t):
    return G.recency(t.events, "ts", "HOUR", 4, ntz("2024-01-31"), group_by=["user_id"])


@query("relationships_where", """SELECT o_custkey AS id FROM orders WHERE o_custkey IS NOT NULL AND o_orderstatus = 'F'
AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def relationships_where(t):
    return G.relationships_where(t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'F'", "c_mktsegment = 'BUILDING'")


@query("sequential_values", """SELECT user_id, event_id, previous_event_id FROM (
  SELECT user_id, event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_event_id FROM events)
WHERE NOT (event_id = previous_event_id + 1)""")
def sequential_values(t):
    return G.sequential_values(t.events, "event_id", 1, group_by=["user_id"])


@query("sequential_values_datepart", """SELECT CAST(o_orderdate AS VARCHAR) AS o_orderdate, CAST(p AS VARCHAR) AS previous_o_orderdate FROM (
  SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS p FROM orders) WHERE NOT (o_orderdate = p + INTERVAL 1 DAY)""")
def sequential_values_datepart(t):
    return G.sequential_values(t.orders, "o_orderdate", 1, "DAY")


@query("unique_combination_of_columns", "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_combination_of_columns(t):
    return G.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("exp_expression_is_true", """SELECT l_suppkey, false AS expression FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey
HAVING NOT (sum(l_quantity) > avg(l_quantity) * 200)""")
def exp_expression_is_true(t):
    return K.expression_is_true(
        t.lineitem, "sum(l_quantity) > avg(l_quantity) * 200", "= true", ["l_suppkey"], "l_returnflag = 'R'"
    )


@query("exp_expression_between", """SELECT c_nationkey, round(sum(c_acctbal), 2) AS observed FROM customer GROUP BY ALL
HAVING NOT (sum(c_acctbal) > 250000 AND sum(c_acctbal) < 290000)""")
def exp_expression_between(t):
    found = K.expression_between(t.customer, "sum(c_acctbal)", 250000, 290000, ["c_nationkey"], strictly=True)
    return rounded(found, 2, "observed")


@query("exp_equal_expression", """SELECT coalesce(a.k, b.k) AS nation, a.e AS expression, b.e AS compare_expression,
  abs(coalesce(a.e, 0) - coalesce(b.e, 0)) AS expression_difference,
  round(abs(coalesce(a.e, 0) - coalesce(b.e, 0)) / nullif(a.e::DOUBLE, 0), 9) AS expression_difference_percent
FROM (SELECT c_nationkey AS k, count(*) AS e FROM customer GROUP BY ALL) a
FULL JOIN (SELECT s_nationkey AS k, count(*) * 10 AS e FROM supplier GROUP BY ALL) b ON a.k = b.k
WHERE abs(coalesce(a.e, 0) - coalesce(b.e, 0)) / nullif(a.e::DOUBLE, 0) > 0.25""")
def exp_equal_expression(t):
    found = K.equal_expression(
        t.customer.withColumnRenamed("c_nationkey", "nation"), "count(*)", t.supplier, "count(*) * 10",
        ["nation"], ["s_nationkey"], tolerance_percent=0.25,
    )
    return rounded(found, 9, "expression_difference_percent")


@query("run_checks", f"""WITH {GOLD}
SELECT 'id not null' AS "check", count(*) FILTER (WHERE id IS NULL) AS failures, 'pass' AS status FROM gold
UNION ALL SELECT 'content not null', count(*) FILTER (WHERE content IS NULL), 'pass' FROM gold
UNION ALL SELECT 'score below one', count(*) FILTER (WHERE NOT quality_score < 1), 'error' FROM gold
UNION ALL SELECT 'first chunks short', count(*) FILTER (WHERE chunk_index = 1 AND NOT length(content) < 900), 'warn' FROM gold
UNION ALL SELECT 'score range', CASE WHEN min(quality_score) >= 0.5 THEN 0 ELSE 1 END, 'pass' FROM gold
UNION ALL SELECT 'many sources', CASE WHEN count(DISTINCT source) > 1000 THEN 0 ELSE 1 END, 'error' FROM gold
UNION ALL SELECT 'id unique', (SELECT count(*) FROM (SELECT id FROM gold GROUP BY id HAVING count(*) > 1)), 'pass'""")
def run_checks(t):
    rows = gold(t)
    return K.run_checks(rows, [
        K.Check("id not null", row="id is not null"),
        K.Check("content not null", row="content is not null"),
        K.Check("score below one", row="quality_score < 1"),
        K.Check("first chunks short", row="length(content) < 900", where="chunk_index = 1", error_if="> 1000000000"),
        K.Check("score range", measure="min(quality_score)", holds=lambda v: v >= 0.5),
        K.Check("many sources", measure="count(distinct source)", holds=lambda v: v > 1000),
        K.Check("id unique", frame=G.unique(rows, "id")),
    ])


def _in_two_runs(t, run):
    """Bronze by days, whose later half and late rows of every day come between two runs."""
    table, kept = scratch_path(t.spark, "days"), scratch_path(t.spark, "kept")
    rows = bronze(t)
    middle = rows.agg(F.percentile_approx(F.col("ingested_at").cast("timestamp"), 0.5)).first()[0]
    early = (F.col("ingested_at") <= ntz(str(middle))) & (F.pmod(F.xxhash64("id"), F.lit(5)) != 0)
    S.create_bronze(rows.where(early), table)
    run(table, kept)
    S.append_bronze(rows.where(~early), table)
    return run(table, kept)


@query("run_checks_kept", f"""WITH {BRONZE}
SELECT 'id not null' AS "check", count(*) FILTER (WHERE id IS NULL) AS failures, 'pass' AS status FROM bronze
UNION ALL SELECT 'short', count(*) FILTER (WHERE NOT length(content) < 300), CASE WHEN count(*) FILTER (WHERE NOT length(content) < 300) > 0 THEN 'error' ELSE 'pass' END FROM bronze
UNION ALL SELECT 'first time', CASE WHEN min(ingested_at) >= TIMESTAMP '2024-01-01' THEN 0 ELSE 1 END, 'pass' FROM bronze
UNION ALL SELECT 'mean length', CASE WHEN avg(length(content)) < 1 THEN 0 ELSE 1 END, 'error' FROM bronze
UNION ALL SELECT 'many sources', CASE WHEN count(DISTINCT source) > 1000 THEN 0 ELSE 1 END, 'error' FROM bronze""")
def run_checks_kept(t):
    checks = [
        P.KeptCheck(P.failures("id not null", "id is not null")),
        P.KeptCheck(P.failures("short", "length(content) < 300")),
        P.KeptCheck(P.least("first time", "ingested_at"), lambda v: v >= ntz("2024-01-01")),
        P.KeptCheck(P.mean("mean length", "length(content)"), lambda v: v < 1),
        P.KeptCheck(P.distinct("many sources", "source"), lambda v: v > 1000),
    ]
    return _in_two_runs(t, lambda table, kept: P.run_kept_checks(t.spark, table, "ingest_day", checks, kept))


@query("measures_kept", f"""WITH {BRONZE}
SELECT source, count(*) AS n, sum(length(content))::BIGINT AS chars, min(length(content)) AS low, max(length(content)) AS high,
  true AS distinct_near, true AS median_near FROM bronze GROUP BY ALL""")
def measures_kept(t):
    """Exact measures per source; sketches within 3 % of the distinct count and 3 % of the ranks."""
    made = [
        P.row_total("n"), P.total("chars", "length(content)"), P.least("low", "length(content)"),
        P.greatest("high", "length(content)"), P.distinct("texts", "content"), P.quantile("middle", "length(content)", 0.5),
    ]
    found = _in_two_runs(t, lambda table, kept: P.measured(t.spark, table, "ingest_day", made, kept, ["source"]))
    middles = found.select(F.col("source").alias("_source"), "texts", "middle")
    size = F.length("content")
    rows = bronze(t).join(middles, F.col("source").eqNullSafe(F.col("_source")))
    near = rows.groupBy("_source", "texts").agg(
        F.count_distinct("content").alias("d"), F.avg((size < F.col("middle")).cast("double")).alias("below"),
        F.avg((size <= F.col("middle")).cast("double")).alias("upto"))
    near = near.select(
        "_source", (F.abs(F.col("texts") - F.col("d")) <= 0.03 * F.col("d")).alias("distinct_near"),
        ((F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_near"))
    return found.join(near, F.col("source").eqNullSafe(F.col("_source"))).select(
        "source", "n", "chars", "low", "high", "distinct_near", "median_near")
