"""Set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import reshape as R
from siltstone.queries.registry import query


@query("union_relations", """SELECT 'customer' AS _source_relation, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, NULL AS acctbal FROM customer
UNION ALL SELECT 'supplier', s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def union_relations(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.lit(1).alias("skipped"))
    b = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"))
    return R.union_relations({"customer": a, "supplier": b}, {"nation": "bigint"}, exclude=["SKIPPED"])


@query("except_symmetric", """SELECT 'a_minus_b' AS which_diff, * FROM
  (SELECT c_nationkey AS nation, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer EXCEPT SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier)
UNION ALL SELECT 'b_minus_a', * FROM
  (SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) FROM supplier EXCEPT SELECT c_nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) FROM customer)""")
def except_symmetric(t):
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 1000).alias("band"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 1000).alias("band"))
    return R.except_symmetric(a, b)


COUNTS = """(SELECT {a} AS nation, count(*) AS num_rows FROM {b} GROUP BY ALL)"""
A_COUNTS, B_COUNTS = COUNTS.format(a="c_nationkey", b="customer"), COUNTS.format(a="s_nationkey", b="supplier")


@query("except_counts", f"""SELECT * FROM ({A_COUNTS} EXCEPT {B_COUNTS}) UNION ALL SELECT * FROM ({B_COUNTS} EXCEPT {A_COUNTS})""")
def except_counts(t):
    a = t.customer.select(F.col("c_nationkey").alias("nation"))
    return R.except_counts(a, "nation", t.supplier, "s_nationkey")


@query("union_all_literals", """SELECT v AS value_field, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('X')) s(v)
LEFT JOIN orders ON o_orderstatus = v GROUP BY ALL""")
def union_all_literals(t):
    values = R.literal_rows(t.spark, ["F", "O", "X"])
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("value_field")).agg(F.count(F.lit(1)).alias("n"))
    return values.join(counts, "value_field", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("unpivot", """SELECT s_suppkey, 'name' AS prop, s_name AS val FROM supplier
UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT s_suppkey, 'in_debt', CAST(s_acctbal < 0 AS VARCHAR) FROM supplier""")
def unpivot(t):
    rows = t.supplier.select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        (F.col("s_acctbal") < 0).alias("in_debt"), "s_acctbal",
    )
    return R.unpivot(rows, exclude=["s_suppkey"], remove=["S_ACCTBAL"], field_name="prop", value_name="val")


@query("generate_series", """SELECT n AS generated_number, count(l_linenumber) AS lines
FROM range(1, (SELECT max(l_linenumber) + 1 FROM lineitem)) r(n) LEFT JOIN lineitem ON l_linenumber = n GROUP BY ALL""")
def generate_series(t):
    series = R.generate_series(t.spark, t.lineitem.agg(F.max("l_linenumber")).first()[0])
    counts = t.lineitem.groupBy(F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(F.count(F.lit(1)).alias("lines"))
    return series.join(counts, "generated_number", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))


@query("date_spine", """SELECT CAST(d AS VARCHAR) AS date_week, count(o_orderkey) AS orders FROM
  (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 7 DAY, INTERVAL 7 DAY)) AS d FROM orders)
  LEFT JOIN orders ON o_orderdate >= d AND o_orderdate < d + INTERVAL 7 DAY GROUP BY ALL""")
def date_spine(t):
    low, high = t.orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    spine = R.date_spine(t.spark, "week", low, high)
    weeks = F.timestamp_diff("week", F.lit(str(low)).cast("timestamp_ntz"), F.col("o_orderdate"))
    start = F.timestamp_add("week", weeks.cast("int"), F.lit(str(low)).cast("timestamp_ntz")).alias("date_week")
    counts = t.orders.groupBy(start).agg(F.count(F.lit(1)).alias("orders"))
    return spine.join(counts, "date_week", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query("base_dates", """SELECT CAST(d AS VARCHAR) AS date_day, count(event_id) AS events FROM
  (SELECT unnest(generate_series(TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d)
  LEFT JOIN events ON date_trunc('day', ts) = d GROUP BY ALL""")
def base_dates(t):
    spine = R.base_dates(t.spark, n_dateparts=20, unit="day", as_of="2024-01-31")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("date_day")
    counts = t.events.groupBy(day).agg(F.count(F.lit(1)).alias("events"))
    return spine.join(counts, "date_day", "left").withColumn("events", F.coalesce("events", F.lit(0)))
