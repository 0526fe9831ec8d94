"""Windows over hot groups, one-shuffle neighbours, interval joins and chunks as a table function, against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from siltstone.functions.chunks import register_table_functions
from siltstone.operators import joins as J
from siltstone.operators import ordered as O
from siltstone.operators import windows as WO
from siltstone.queries import load


@pytest.fixture
def periods(spark):
    """One group with nine tenths of the periods."""
    rng = random.Random(4)
    rows = [("hot" if i % 10 else f"g{i % 30}", i, None if rng.random() < 0.1 else float(rng.randrange(100))) for i in range(1500)]
    return spark.createDataFrame(rows + [(None, i, 1.0 * i) for i in range(5)], "g string, day int, v double").repartition(6)


@pytest.mark.parametrize("by", [["g"], []])
def test_windows_of_blocks_equal_plain_windows(periods, monkeypatch, by):
    monkeypatch.setattr(WO, "BLOCK_ROWS", 16)
    rows = periods if by else periods.where("g = 'hot'")
    plain = W.partitionBy(*by).orderBy("day")
    shown = lambda d, *c: sorted(((r.g, r.day, *[None if r[x] is None else round(r[x], 6) for x in c]) for r in d.collect()), key=str)
    window = plain.rowsBetween(-4, -1)
    expected = rows.withColumns({"m_average": F.avg("v").over(window), "m_stddev": F.stddev_samp("v").over(window)})
    assert shown(WO.moving_stats(rows, by, "day", "v", 4, "m"), "m_average", "m_stddev") == shown(expected, "m_average", "m_stddev")
    expected = rows.withColumn("prior_v", F.lag("v", 20).over(plain))
    assert shown(WO.lag_difference(rows, by, "day", "v", 20, take_logs=False), "prior_v") == shown(expected, "prior_v")
    for descending in (False, True):
        order = F.desc("day") if descending else F.asc("day")
        expected = rows.withColumn("s", F.sum("v").over(W.partitionBy(*by).orderBy(order)))
        assert shown(WO.rolling_sum(rows, by, "day", "v", "s", descending), "s") == shown(expected, "s")


def test_no_task_holds_a_hot_group(spark, periods, monkeypatch):
    monkeypatch.setattr(WO, "BLOCK_ROWS", 16)
    sizes = []

    def kept(window):
        sizes.append(window)
        return {"n": F.count(F.lit(1)).over(window.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))}

    found = WO.over_blocks(periods, ["g"], "day", 4, kept).where("g = 'hot'").select("n").collect()
    assert max(r.n for r in found) <= 16 + 4 and len(found) == 1350


def test_neighbours_take_one_shuffle(spark, periods, monkeypatch):
    """What is checkpointed has been shuffled by range once, and not again by the range's number."""
    plans = []

    def looked_at(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    real = O.settle
    monkeypatch.setattr(O, "settle", looked_at)
    found = O.with_neighbour(periods, ["g"], ["day"], "v", "before", ranges=5)
    assert len(plans) == 1 and plans[0].count("rangepartitioning") == 1 and "hashpartitioning" not in plans[0]
    expected = periods.withColumn("before", F.lag("v").over(W.partitionBy("g").orderBy("day")))
    assert sorted(map(str, found.select("g", "day", "before").collect())) == sorted(map(str, expected.select("g", "day", "before").collect()))
    ahead = O.with_neighbour(periods, ["g"], ["day"], F.struct("v", "day"), "after", ahead=True, ranges=7)
    expected = periods.withColumn("after", F.lead(F.struct("v", "day")).over(W.partitionBy("g").orderBy("day")))
    assert sorted(map(str, ahead.select("g", "day", "after").collect())) == sorted(map(str, expected.select("g", "day", "after").collect()))


def test_intervals_of_any_length(spark):
    """Ranges of ten years and of seconds, before and after the epoch, against every pair."""
    rng = random.Random(5)
    year = 365 * 86400
    ranges = [(i, s := rng.randrange(-20 * year, 20 * year), s + rng.choice([0, 1, 15, 16, 17, 3600, year, 10 * year, -5])) for i in range(60)]
    ranges += [(100, None, 5), (101, 5, None), (102, -1, 1), (103, 0, 16), (104, -16, 0)]
    facts = [(i, rng.choice([rng.randrange(-20 * year, 30 * year), *[e for _, s, e in ranges[:40] if e is not None]])) for i in range(400)]
    facts += [(900, None), (901, 0), (902, -1), (903, -16), (904, 15), (905, 16)]
    left, right = spark.createDataFrame(facts, "id int, at long"), spark.createDataFrame(ranges, "span int, s long, e long")
    found = J.join_intervals(left, F.col("at"), right, F.col("s"), F.col("e"))
    assert found.columns == ["id", "at", "span", "s", "e"]
    expected = sorted((i, n) for i, x in facts for n, s, e in ranges if None not in (x, s, e) and s <= x < e)
    assert sorted((r.id, r.span) for r in found.collect()) == expected
    blocks = right.where("s < e").select(F.size(J.interval_blocks(F.col("s"), F.col("e"))).alias("n"), (F.col("e") - F.col("s")).alias("long")).collect()
    assert all(r.n <= 30 * (1 + math.log(r.long, 16)) for r in blocks)
    assert J.join_intervals(left, F.col("at"), right.limit(0), F.col("s"), F.col("e")).count() == 0


def test_parts_of_intervals_add_up_to_the_pairs(spark):
    """Facts of one block are one row when they meet the ranges, however many they are."""
    rng = random.Random(6)
    facts = [(i, rng.randrange(-500, 5000), None if i % 7 == 0 else i / 4) for i in range(300)] + [(i, 4096 + i % 16, 1.0) for i in range(300, 800)]
    ranges = [(i, s := rng.randrange(-500, 5000), s + rng.choice([0, 1, 16, 300, 4000])) for i in range(50)] + [(50, 4096, 4112), (51, None, 3)]
    left, right = spark.createDataFrame(facts, "id int, at int, v double"), spark.createDataFrame(ranges, "span int, s int, e int")
    parts = [F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"), F.min("id").alias("low"), F.max("id").alias("high")]
    joined = J.join_intervals(left, F.col("at"), right, F.col("s"), F.col("e"), parts)
    assert joined.where("span = 50").count() == 1
    found = joined.groupBy("span").agg(F.sum("n"), F.sum("total"), F.min("low"), F.max("high")).collect()
    expected = []
    for n, s, e in ranges:
        inside = [(i, v) for i, at, v in facts if s is not None and s <= at < e]
        known = [v for _, v in inside if v is not None]
        if inside:
            expected.append((n, len(inside), sum(known) if known else None, min(inside)[0], max(inside)[0]))
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_chunks_of_a_query_are_cut_where_the_texts_lie(spark, tmp_path):
    """Texts of one language are not sent to one task."""
    docs = spark.createDataFrame([(i, "ab" * (i * 100), "en") for i in range(1, 20)], "doc_id long, text string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = load()[0]["chunk_text_udtf"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "Exchange" not in plan
    assert found.count() == sum(max(1, math.ceil((200 * i - 100) / 900)) for i in range(1, 20))


@pytest.mark.parametrize("size,overlap", [(10, 0), (10, 3), (4, 3)])
def test_chunks_in_sql(spark, size, overlap):
    register_table_functions(spark)
    rows = [("a", "x" * 9, "s"), ("b", "abcdefghijklmnopqrstuvwxyz", "t"), ("c", "", "s"), ("d", None, "s"), ("e", "é\U0001f600" * 11, None)]
    spark.createDataFrame(rows, "id string, content string, source string").createOrReplaceTempView("chunk_rows")
    found = spark.sql(f"SELECT * FROM overlapping_chunks({size}, {overlap}, TABLE(chunk_rows) PARTITION BY source)").collect()
    expected, step = [], size - overlap
    for key, text, _ in rows:
        if text is not None:
            total = max(1, math.ceil((len(text) - overlap) / step))
            expected += [(key, i + 1, total, f"{key}-{i + 1}", text if total == 1 else text[i * step : i * step + size]) for i in range(total)]
    assert sorted(map(tuple, found)) == sorted(expected)


def test_documents_beyond_two_billion(spark):
    from siltstone.sources.tables import bronze_from_documents

    docs = spark.createDataFrame([(3_000_000_000, "t", "en", "s", 1), (1, "t", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.id: str(r.ingested_at) for r in bronze_from_documents(docs).collect()}
    assert found["1"] == "2024-01-01 00:01:00" and found["3000000000"].startswith("7727")
