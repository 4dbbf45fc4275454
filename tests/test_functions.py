"""Scalar building blocks and dashboard selections on hand rows."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from skyframe import fixed
from skyframe.functions import scalars as S
from skyframe.operators import charts, query as Q


@pytest.mark.parametrize("v,label", [(35, "30~40℃"), (40, "30~40℃"), (41, None), (30.5, None), (30, "20~30℃"),
                                     (0.5, None), (1, "0~10℃"), (0, "-10~0℃"), (-10, "-10~0℃"), (-11, None),
                                     (None, None)])
def test_piece_gaps(spark, v, label):
    df = spark.createDataFrame([(None if v is None else float(v),)], "v double")
    assert df.select(S.pieces("v").alias("p")).first()["p"] == label


@pytest.mark.parametrize("text,want", [("西北风3级", "西北风"), ("东北风2级", "东北风"), ("东风", "东风"),
                                       ("无持续风向微风", "无"), ("北风", "北风"), ("", ""), (None, None)])
def test_leading_wind_word(spark, text, want):
    df = spark.createDataFrame([(text,)], "w string")
    assert df.select(S.leading_token("w", fixed.WIND_DOMAIN).alias("t")).first()["t"] == want


def test_leading_token_generic(spark):
    df = spark.createDataFrame([("small ring",), ("  blue bolt",)], "w string")
    assert [r[0] for r in df.select(S.leading_token("w")).collect()] == ["small", "blue"]


def test_url_param(spark):
    urls = [("http://h/x?areaInfo%5BareaId%5D=60198&areaInfo%5BareaType%5D=2",),
            ("http://h/x?page=12#top",), ("http://h/x?xpage=3",), ("http://h/x",)]
    df = spark.createDataFrame(urls, "u string")
    got = df.select(S.url_param("u", fixed.AREA_KEY, width=fixed.AREA_ID_WIDTH).alias("a"),
                    S.url_param("u", "page").alias("p")).collect()
    assert [(r.a, r.p) for r in got] == [("60198", None), (None, "12"), (None, None), (None, None)]


def test_domain_ordinal_dedups_and_unknown(spark):
    df = spark.createDataFrame([("西南风",), ("无",), ("大风",), (None,)], "w string")
    got = [r[0] for r in df.select(S.domain_ordinal("w", fixed.WIND_DOMAIN)).collect()]
    assert got == [1, 9, None, None]


@pytest.mark.parametrize("bad", ["2016-1", "201601", "16", "2016-01-1", "abcd"])
def test_invalid_period_rejected(bad):
    with pytest.raises(ValueError):
        S.check_period(bad)


def test_project_requires_labels(spark):
    df = spark.createDataFrame([(1,)], "max_t int")
    with pytest.raises(ValueError):
        Q.project(df, [])


def test_label_order_and_longest_label_first(spark):
    df = spark.createDataFrame([(1.0, "优")], "aqi double, aqi_type string")
    out = Q.project(df, ["空气质量", "空气质量指数"])
    assert out.columns == ["空气质量", "空气质量指数"]
    assert tuple(out.first()) == ("优", 1.0)


def test_place_suffix_removed(spark):
    df = spark.createDataFrame([("朝阳", "2016-01-01"), ("昌平", "2016-01-01")], "district string, year_mon_day string")
    assert Q.in_district(df, "朝阳区").count() == 1


def test_trend_day_grain_is_empty(spark):
    df = spark.createDataFrame([("朝阳", "2016-01-01", 5, -6)], "district string, year_mon_day string, max_t int, min_t int")
    assert charts.trend(df, "朝阳区", "2016-01-01").count() == 0
    assert charts.trend(df, "朝阳区", "2016-01").first()["mean_t"] == -0.5


def test_class_pivot_zero_fill(spark):
    df = spark.createDataFrame([("优",), ("优",), ("严重污染",), (None,)], "aqi_type string")
    r = charts.class_pivot(df).first().asDict()
    assert r == {"优": 2, "良": 0, "轻度污染": 0, "中度污染": 0, "重度污染": 0, "严重污染": 1}


def test_category_counts_keep_null(spark):
    df = spark.createDataFrame([("晴",), (None,), (None,)], "weather string")
    got = {r["weather"]: r["n"] for r in charts.category_counts(df).collect()}
    assert got == {"晴": 1, None: 2}


def test_extents_ignore_nulls(spark):
    df = spark.createDataFrame([(5, -6, None), (3, -5, 42.0)], "max_t int, min_t int, aqi double")
    r = charts.extents(df).first()
    assert (r.max_t_hi, r.max_t_lo, r.min_t_hi, r.min_t_lo, r.aqi_hi, r.aqi_lo) == (5, 3, -5, -6, 42.0, 42.0)


def test_category_mean_half_even(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "weather string, aqi double")
    got = {r[0]: r[1] for r in charts.category_mean(df).collect()}
    assert got == {"a": 1.5, "b": None}


DATES = st.dates(min_value=__import__("datetime").date(2016, 1, 1), max_value=__import__("datetime").date(2018, 12, 31))


@settings(max_examples=10, deadline=None)
@given(st.lists(DATES, min_size=1, max_size=30), st.sampled_from(["", "2016", "2017-02", "2018-12-31", "2016-07"]))
def test_prefix_equals_substring_form(spark, days, period):
    df = spark.createDataFrame([(d.isoformat(),) for d in days], "year_mon_day string")
    a = sorted(r[0] for r in Q.in_period(df, period).collect())
    n = len(period)
    b = sorted(r[0] for r in df.filter(F.lit(n == 0) | (F.substring("year_mon_day", 1, n) == period)).collect())
    assert a == b


def test_year_count_is_sum_of_months(spark):
    rows = [("A", f"2016-{m:02d}-{d:02d}") for m in range(1, 13) for d in (1, 15, 28)]
    df = spark.createDataFrame(rows, "district string, year_mon_day string")
    months = sum(Q.in_period(df, f"2016-{m:02d}").count() for m in range(1, 13))
    assert Q.in_period(df, "2016").count() == months == 36


def test_shares_sum_to_one(spark, sf_dir):
    import __spark_entry__ as E
    total = E.queries()["category_share"](spark, sf_dir).agg(F.sum("share")).first()[0]
    assert abs(total - 1.0) < 1e-9


def test_lenient_double_takes_plain_decimals_only(spark):
    from skyframe.functions.scalars import lenient_double
    cases = {"42": 42.0, " 7 ": 7.0, "-1.5": -1.5, "1e2": 100.0, ".5": 0.5, "5.": 5.0, "42d": None, "42f": None, "0x1p3": None, "-": None, "": None, "NaN": None, "inf": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.v for r in df.select("t", lenient_double("t").alias("v")).collect()} == cases


def test_periods_and_places_are_checked():
    import pytest
    from skyframe.functions.scalars import check_period
    from skyframe.operators.query import check_place
    for bad in ("2016\n", "２０１６", "2016-1"):
        with pytest.raises(ValueError):
            check_period(bad)
    assert check_place("朝阳区") == "朝阳区" and check_place("朝阳") == "朝阳" and check_place(None) is None
    with pytest.raises(ValueError):
        check_place("ASIA区")
