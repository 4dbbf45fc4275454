"""Cleaning traps on hand-made rows (ODS -> DWD)."""

import pytest
from pyspark.sql import functions as F

from skyframe.operators import clean as C
from skyframe.schema import ODS

# district, year_mon_day, week, max_t, min_t, weather, wind, aqi, aqi_type
ROWS = [
    ("朝阳", "2016-01-01", "周五", "5°", "-6°", "晴", "西北风", "42", "优"),
    ("朝阳", "2017-01-01", "周日", "3°", "-5°", "霾", "无", "43", "优"),
    ("朝阳", "2018-01-01", "周一", "4°", "-6°", "晴", "北风", "", ""),
    ("昌平", "2016-01-02", "周六", "2°", "-8°", "多云", "东风", "-", ""),
]


def ods(spark, rows=ROWS):
    return spark.createDataFrame(rows, ODS)


def by_key(df):
    return {(r["district"], r["year_mon_day"]): r for r in df.collect()}


def test_gap_filled_with_half_even_group_mean(spark):
    out = by_key(C.clean(ods(spark)))
    # mean of 42 and 43 is 42.5 -> 42 (half to even; half-up would give 43)
    assert out[("朝阳", "2018-01-01")]["aqi"] == 42.0
    assert out[("朝阳", "2018-01-01")]["aqi_type"] == "优"
    # a group without any value stays NULL, and so does its class
    assert out[("昌平", "2016-01-02")]["aqi"] is None
    assert out[("昌平", "2016-01-02")]["aqi_type"] is None
    # existing values are rounded too and keep their class
    assert out[("朝阳", "2016-01-01")]["aqi"] == 42.0


def test_types_follow_dwd_schema(spark):
    d = C.clean(ods(spark))
    types = dict(d.dtypes)
    assert types["max_t"] == "int" and types["min_t"] == "int" and types["aqi"] == "double"
    r = by_key(d)[("朝阳", "2016-01-01")]
    assert (r["max_t"], r["min_t"]) == (5, -6)


def test_whole_column_rounded_half_even(spark):
    rows = [("A", "2016-03-01", "w", "1°", "0°", "x", "y", "2.5", None),
            ("A", "2017-03-01", "w", "1°", "0°", "x", "y", "3.5", None),
            ("A", "2018-03-01", "w", "1°", "0°", "x", "y", None, None)]
    out = by_key(C.clean(ods(spark, rows)))
    assert out[("A", "2016-03-01")]["aqi"] == 2.0
    assert out[("A", "2017-03-01")]["aqi"] == 4.0
    assert out[("A", "2018-03-01")]["aqi"] == 3.0  # mean 3.0


def test_null_key_keeps_own_value(spark):
    rows = [(None, "2016-03-01", "w", "1°", "0°", "x", "y", "7.5", None),
            (None, "2017-03-01", "w", "1°", "0°", "x", "y", None, None)]
    got = sorted((r["year_mon_day"], r["aqi"]) for r in C.clean(ods(spark, rows)).collect())
    assert got == [("2016-03-01", 8.0), ("2017-03-01", None)]


@pytest.mark.parametrize("aqi,band", [(50, "优"), (50.5, "良"), (51, "良"), (100, "良"), (150, "轻度污染"),
                                      (200, "中度污染"), (300, "重度污染"), (301, "严重污染"), (0, "优"),
                                      (None, None)])
def test_band_edges(spark, aqi, band):
    df = spark.createDataFrame([(None if aqi is None else float(aqi),)], "aqi double")
    assert C.classify_aqi(df).first()["aqi_type"] == band


@pytest.mark.parametrize("text,want", [("-", None), ("", None), ("NaN", None), ("42", 42.0), ("4.5", 4.5),
                                       (None, None)])
def test_lenient_aqi(spark, text, want):
    df = spark.createDataFrame([(text,)], "aqi string")
    assert C.cast_aqi(df).first()["aqi"] == want


def test_strict_int_rejects_malformed(spark):
    df = spark.createDataFrame([("5°", "x°")], "max_t string, min_t string")
    with pytest.raises(Exception, match="strict_int"):
        C.cast_temperatures(df).collect()


def test_strict_int_rejects_null_unless_kept(spark):
    df = spark.createDataFrame([("5°", None)], "max_t string, min_t string")
    with pytest.raises(Exception, match="strict_int"):
        C.cast_temperatures(df).collect()
    r = C.cast_temperatures(df, on_null="keep").first()
    assert (r["max_t"], r["min_t"]) == (5, None)


def test_sort_nulls_last(spark):
    rows = [(None, "2016-01-01"), ("B", "2016-01-02"), ("A", "2016-01-03"), ("A", "2016-01-01")]
    df = spark.createDataFrame(rows, "district string, year_mon_day string")
    got = [(r[0], r[1]) for r in C.sort_obs(df).collect()]
    assert got == [("A", "2016-01-01"), ("A", "2016-01-03"), ("B", "2016-01-02"), (None, "2016-01-01")]


def test_clean_is_idempotent_on_integral_aqi(spark):
    once = C.clean(ods(spark))
    back = once.select(
        "district", "year_mon_day", "week",
        F.concat(F.col("max_t").cast("string"), F.lit("°")).alias("max_t"),
        F.concat(F.col("min_t").cast("string"), F.lit("°")).alias("min_t"),
        "weather", "wind", F.col("aqi").cast("string").alias("aqi"), "aqi_type")
    twice = C.clean(back)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_group_means_are_broadcast(spark):
    from plan_text import plan_text
    plan = plan_text(C.clean(ods(spark)))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_gap_filling_same_beyond_broadcast_bound(spark, sf_dir):
    from plan_text import plan_text
    from skyframe.plans.registry import ods
    staged = C.cast_aqi(ods(spark, sf_dir))
    small = C.impute_group_mean(staged)
    cols = ["l_orderkey", "l_linenumber", "district", "year_mon_day", "aqi"]
    a = sorted(map(tuple, small.select(*cols).collect()), key=str)
    # beyond Spark's threshold the join is a shuffle join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = C.impute_group_mean(staged)
        plan = plan_text(big, "simple")
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        b = sorted(map(tuple, big.select(*cols).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert a == b


def test_dealing_staged_rows_out_changes_no_row(spark):
    plain, seen = C.clean(ods(spark)), []

    def deal(df):
        seen.append(df.columns)
        return df.repartition(3, "year_mon_day")

    dealt = C.clean(ods(spark), deal=deal)
    assert seen == [ods(spark).columns]
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
