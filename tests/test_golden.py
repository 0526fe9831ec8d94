"""Small inputs with known results."""

from datetime import date, datetime, timedelta

import hashlib

import pytest
from pyspark.sql import functions as F

from siltstone.functions import dates as D
from siltstone.functions import maths as M
from siltstone.functions import text as X
from siltstone.operators import aggregates as A
from siltstone.operators import calendar as C
from siltstone.operators import project as P
from siltstone.operators import reshape as R
from siltstone.operators import windows as WO


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    best = WO.deduplicate(df.where("user_id = 1"), ["user_id"], [F.desc("version")])
    assert rows(best) == [(1, "play", 2)]
    assert rows(WO.latest_per_key(df, ["user_id"], ["version"])) == [(1, "play", 2), (2, "pause", 1)]


def test_deduplicate_keeps_rows_with_null(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, None, 2)], "k int, note string, version int")
    assert rows(WO.deduplicate(df, ["k"], [F.desc("version")])) == [(1, None, 2)]


def test_pivot(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(A.pivot(df, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    wide = A.pivot(df, ["size"], "color", ["red", "blue", "blue's"], slugify=True)
    assert wide.columns == ["size", "red", "blue", "blues"]
    assert rows(wide) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_distinct_and_comparison(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("b", 9)], "k string, v int")
    at_least = A.pivot(df, ["k"], "v", [5], cmp=">=", then_value="v", else_value=None, agg="sum", distinct=True)
    assert rows(at_least) == [("a", 5), ("b", 9)]


@pytest.mark.parametrize(("name", "expected"), [
    ("Hello World", "hello_world"), ("a - b", "a_b"), ("9 lives", "_9_lives"), ("blue's", "blues"), ("a__b", "a__b"),
])
def test_slug(name, expected):
    assert X.slug(name) == expected


def test_unpivot(spark, rows):
    df = spark.createDataFrame(
        [(1, "mon", "up", 10, None), (2, "tue", None, 20, True)],
        "machine int, day string, state string, load int, checked boolean",
    )
    found = R.unpivot(df, exclude=["machine"], remove=["DAY"], field_name="what", value_name="reading")
    assert set(rows(found)) == {
        (1, "state", "up"), (1, "load", "10"), (1, "checked", None),
        (2, "state", None), (2, "load", "20"), (2, "checked", "true"),
    }


def test_union_relations(spark, rows):
    a = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    both = R.union_relations({"a": a, "b": b}, source_column=None)
    assert set(rows(both, "id", "name", "favorite_color", "favorite_number")) == {
        (1, "drew", None, "pi"), (2, "bob", None, "e"), (3, "alice", None, "4"), (1, None, "green", "7"), (2, None, "pink", "13"),
    }
    tagged = R.union_relations({"a": a, "b": b}, exclude=["NAME"], where="id = 1")
    assert tagged.columns == ["_source_relation", "id", "favorite_number", "favorite_color"]
    assert set(rows(tagged)) == {("a", 1, "pi", None), ("b", 1, "7", "green")}
    with pytest.raises(ValueError):
        R.union_relations({"a": a}, include=["id"], exclude=["name"])


def test_generate_series(spark):
    assert [r[0] for r in R.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        R.generate_series(spark, 0)


def test_date_spine_excludes_its_end(spark):
    days = [r[0].date() for r in R.date_spine(spark, "day", "2018-01-01", "2018-01-10").orderBy("date_day").collect()]
    assert days == [date(2018, 1, d) for d in range(1, 10)]
    assert R.date_spine(spark, "day", "2018-01-10", "2018-01-01").count() == 0
    assert R.date_spine(spark, "month", "2018-01-31", "2018-04-30").count() == 2


def test_base_dates(spark):
    days = [r[0].date() for r in R.base_dates(spark, n_dateparts=2, as_of="2020-03-01").orderBy("date_day").collect()]
    assert days == [date(2020, 2, 28), date(2020, 2, 29), date(2020, 3, 1)]
    with pytest.raises(ValueError):
        R.base_dates(spark)


def test_surrogate_key(spark, rows):
    parts = [("x", "1", "yy"), ("x", None, "yy"), (None, "", None)]
    df = spark.createDataFrame(parts, "p string, q string, r string")
    found = df.select(X.surrogate_key(["q"]).alias("one"), X.surrogate_key(["p", "q", "r"]).alias("all")).collect()

    def key(*values):
        return hashlib.md5("-".join(X.NULL_KEY_PART if v is None else v for v in values).encode()).hexdigest()

    assert [tuple(r) for r in found] == [(key(q), key(p, q, r)) for p, q, r in parts]
    with pytest.raises(TypeError):
        X.surrogate_key("p")


def test_nullcheck(spark, rows):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert rows(P.nullcheck(df)) == [(None, None, 3), (None, "b", 2), ("a", None, 1)]


def test_star(spark):
    df = spark.createDataFrame([(1, 2, 3)], "field_1 int, field_2 int, field_3 int")
    assert P.star(df, ["FIELD_3"], prefix="p_", suffix="_s").columns == ["p_field_1_s", "p_field_2_s"]


@pytest.mark.parametrize(("values", "total", "rest"), [((1, 2, 3), 6, -4), ((1, None, 3), 4, -2), ((None, None, 2), 2, -2), ((None, None, None), 0, 0)])
def test_safe_add_and_subtract(spark, values, total, rest):
    df = spark.createDataFrame([values], "a int, b int, c int")
    assert tuple(df.select(M.safe_add(["a", "b", "c"]), M.safe_subtract(["a", "b", "c"])).first()) == (total, rest)
    with pytest.raises(TypeError):
        M.safe_add("a")


@pytest.mark.parametrize(("n", "d", "expected"), [(6, 0, None), (10, 5, 2), (None, None, None), (None, 0, None), (17, None, None), (0, None, None), (None, 9, None), (0, 5, 0)])
def test_safe_divide(spark, n, d, expected):
    df = spark.createDataFrame([(n, d)], "n int, d int")
    assert df.select(M.safe_divide("n", "d")).first()[0] == expected


@pytest.mark.parametrize(("amount", "bucket"), [
    (190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3), (510000.0, 4), (610000.0, 5),
])
def test_width_bucket(spark, amount, bucket):
    assert one(spark, M.width_bucket(F.lit(amount), 200000.0, 600000.0, 4)) == bucket


def test_haversine(spark):
    places = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(one(spark, M.haversine(*places, unit="km"))) == 430
    assert round(one(spark, M.haversine(*places))) == 267
    with pytest.raises(ValueError):
        M.haversine(*places, unit="m")


@pytest.mark.parametrize(("url", "host"), [
    ("shop.test?a=1&b=2", "shop.test"), ("http://one.two.test/x/y/", "one.two.test"), ("https://deep.test/2020/01", "deep.test"),
    ("android-app://app.test/", "app.test"), ("plain.test/file.js?v=3", "plain.test"), ("https://bare.test/", "bare.test"),
])
def test_url_host(spark, url, host):
    assert one(spark, X.url_host(F.lit(url))) == host


@pytest.mark.parametrize(("url", "path"), [
    ("shop.test?a=1&b=2", ""), ("http://one.two.test/x/y/", "x/y/"), ("https://deep.test/2020/01", "2020/01"),
    ("http://one.two.test/x/y/?a=1", "x/y/"),
])
def test_url_path(spark, url, path):
    assert one(spark, X.url_path(F.lit(url))) == path


def test_url_parameter(spark):
    url = "https://maps.example.org/route?from=oslo&mode=rail&via="
    assert one(spark, X.url_parameter(F.lit(url), "from")) == "oslo" and one(spark, X.url_parameter(F.lit(url), "mode")) == "rail"
    assert one(spark, X.url_parameter(F.lit(url), "via")) is None
    assert one(spark, X.url_parameter(F.lit(url), "absent")) is None


@pytest.mark.parametrize(("position", "occurrence", "expected"), [(1, 1, 2), (1, 2, 4), (1, 3, 7), (1, 4, 0), (3, 1, 4), (5, 2, 0)])
def test_match_position(spark, position, occurrence, expected):
    assert one(spark, X.match_position(F.lit("a1b22c3"), "[0-9]+", position, occurrence)) == {
        (1, 1): 2, (1, 2): 4, (1, 3): 7, (1, 4): 0, (3, 1): 4, (5, 2): 7
    }[(position, occurrence)]


@pytest.mark.parametrize(("text", "pattern", "position", "occurrence", "expected"), [
    ("aa", "^a", 1, 2, 0), ("xab a", r"\ba", 2, 1, 5), ("xab", "(?<=x)a", 2, 1, 2), ("abab", "b", 5, 1, 0), ("abc", "", 2, 2, 3),
])
def test_matches_see_the_uncut_text(spark, text, pattern, position, occurrence, expected):
    assert one(spark, X.match_position(F.lit(text), pattern, position, occurrence)) == expected


def test_match_position_of_null_and_flags(spark):
    assert one(spark, X.match_position(F.lit(None).cast("string"), "a", 1, 2)) is None
    assert one(spark, X.match_position(F.lit("xAB"), "ab", flags="i")) == 2


def test_trim_and_hash(spark):
    assert one(spark, X.trim_space(F.lit("\t a b \n\r"))) == "a b"
    assert one(spark, X.content_hash(F.lit("  ABC\n"))) == one(spark, X.content_hash(F.lit("abc")))
    assert one(spark, X.content_hash(F.lit("abc"))) == "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD"


@pytest.mark.parametrize("text", ["", " ", "a  b ", " a", "a b c"])
def test_word_count_counts_empty_pieces(spark, text):
    assert one(spark, X.word_count(F.lit(text))) == len(text.split(" "))


def test_metadata(spark):
    assert one(spark, X.parse_metadata(F.lit('{"a": "b", "n": 1}'))) == {"a": "b", "n": "1"}
    assert one(spark, X.parse_metadata(F.lit("plain"))) == {"raw": "plain"}
    assert one(spark, X.parse_metadata(F.lit(None).cast("string"))) is None
    assert one(spark, X.normalise_metadata(F.lit(None).cast("string"))) == "{}"
    assert one(spark, X.normalise_metadata(F.lit("plain"))) == '{"raw":"plain"}'
    assert one(spark, X.json_to_vector(F.lit("[0.5, 1]"))) == [0.5, 1.0]


def test_scalar_value(spark, rows):
    empty = spark.createDataFrame([], "v int")
    assert rows(A.scalar_value(empty, 7)) == [(7,)]
    assert rows(A.scalar_value(spark.createDataFrame([(None,)], "v int"), 7)) == [(None,)]


def test_literal_rows_and_column_values(spark, rows):
    df = spark.createDataFrame([(c,) for c in "abcdefggggg"], "field string")
    assert [r[0] for r in A.column_values(df, "field", 3).collect()] == ["g", "a", "b"]
    assert rows(R.literal_rows(spark, ["x", "y"])) == [("x",), ("y",)]


# Attributes of two days.
GOLDEN_DAYS = {
    date(2020, 11, 29): dict(
        prior=date(2020, 11, 28), next=date(2020, 11, 30), name="Sunday", short="Sun", dom=29, dow=1, iso=7, doy=334,
        start=date(2020, 11, 23), end=date(2020, 11, 29), week=48, month=11, month_name="November", month_short="Nov",
        sunday=date(2020, 11, 29), saturday=date(2020, 12, 5), simple=48,
    ),
    date(2020, 12, 1): dict(
        prior=date(2020, 11, 30), next=date(2020, 12, 2), name="Tuesday", short="Tue", dom=1, dow=3, iso=2, doy=336,
        start=date(2020, 11, 30), end=date(2020, 12, 6), week=49, month=12, month_name="December", month_short="Dec",
        sunday=date(2020, 11, 29), saturday=date(2020, 12, 5), simple=48,
    ),
}


@pytest.mark.parametrize("day", list(GOLDEN_DAYS))
def test_golden_days(spark, day):
    d = F.lit(day)
    found = spark.range(1).select(
        D.yesterday(d).alias("prior"), D.tomorrow(d).alias("next"), D.day_name(d, False).alias("name"), D.day_name(d).alias("short"),
        D.day_of_month(d).alias("dom"), D.day_of_week(d, False).alias("dow"), D.day_of_week(d).alias("iso"), D.day_of_year(d).alias("doy"),
        D.week_start(d).alias("start"), D.week_end(d).alias("end"), D.week_of_year(d).alias("week"), D.date_part("month", d).alias("month"),
        D.month_name(d, False).alias("month_name"), D.month_name(d).alias("month_short"), D.week_start(d, True).alias("sunday"),
        D.week_end(d, True).alias("saturday"), D.week_of_year(d, True).alias("simple"),
    ).first().asDict()
    assert found == GOLDEN_DAYS[day]


def test_epochs_and_zones(spark):
    stamp = datetime(2021, 6, 7, 14, 35, 20)
    assert one(spark, D.from_unix(F.lit(1623076520))) == stamp
    assert one(spark, D.from_unix(F.lit(1623076520000), "milliseconds")) == stamp
    assert one(spark, D.from_unix(F.lit(1623076520000000), "microseconds")) == stamp
    assert one(spark, D.from_unix(F.lit(1623076520000000999), "nanoseconds")) == stamp
    assert one(spark, D.to_unix(F.lit(stamp).cast("timestamp_ntz"))) == 1623076520
    local = D.convert_timezone(F.lit(stamp).cast("timestamp_ntz"), "America/Los_Angeles")
    assert one(spark, local) == datetime(2021, 6, 7, 7, 35, 20)
    assert one(spark, D.round_timestamp(F.lit(stamp).cast("timestamp_ntz"))) == datetime(2021, 6, 8)
    assert one(spark, D.round_timestamp(local)) == datetime(2021, 6, 7)
    with pytest.raises(ValueError):
        D.from_unix(F.lit(1), "hours")


def test_date_dimension_and_fiscal_calendar(spark):
    calendar = C.date_dimension(R.date_spine(spark, "day", "2015-01-01", "2022-12-31")).cache()
    assert len(calendar.columns) == 36
    assert calendar.count() == 2921
    leap = calendar.where("date_day = date'2020-02-29'").first()
    assert leap.prior_year_date_day == date(2019, 2, 28) and leap.month_end_date == date(2020, 2, 29)
    periods = C.fiscal_periods(calendar, 1, 1, 1).cache()
    # Each fiscal year starts on a Sunday, holds 52 or 53 weeks and is cut 4-5-4.
    per_year = periods.groupBy("fiscal_year_number").agg(
        F.count_distinct("fiscal_week_of_year").alias("weeks"), F.min("date_day").alias("start"), F.count(F.lit(1)).alias("days")
    ).orderBy("fiscal_year_number").collect()
    ends = []
    for year in range(2015, 2023):
        sundays = [date(year, 1, d) for d in range(1, 32) if date(year, 1, d).weekday() == 6]
        ends.append(min((s + timedelta(6) for s in sundays), key=lambda e: abs(e - date(year, 1, 31))))
    assert [r.days for r in per_year] == [(b - a).days for a, b in zip(ends, ends[1:])]
    assert [r.weeks * 7 for r in per_year] == [r.days for r in per_year]
    assert 53 in [r.weeks for r in per_year]
    assert all(r.start.weekday() == 6 for r in per_year)
    lengths = periods.where("fiscal_year_number = 2018").groupBy("fiscal_period_number").agg(
        F.count_distinct("fiscal_week_of_year").alias("n")
    ).orderBy("fiscal_period_number").collect()
    assert [r.n for r in lengths] == [4, 5, 4] * 4
    assert periods.where("fiscal_week_of_year = 53").select("fiscal_period_of_quarter").distinct().collect()[0][0] == 3
    assert C.fiscal_dimension(calendar, periods).count() == 2921
