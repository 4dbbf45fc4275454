"""Landed frames are broadcast by their bytes; key filters keep rows."""

from plan_text import plan_text
from skyframe.operators.joins import keys_present, materialize_sized


def test_a_landed_frame_is_broadcast_by_its_bytes(spark):
    big = spark.range(0, 50_000).withColumnRenamed("id", "k")
    agg = materialize_sized(spark.range(0, 1_000).selectExpr("id % 50 AS k").groupBy("k").count())
    assert "BroadcastHashJoin" in plan_text(big.join(agg, "k"), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_text(big.join(agg, "k"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_present(spark):
    big = spark.range(0, 10_000).selectExpr("id % 100 AS k", "id AS v")
    small = spark.createDataFrame([(3,), (7,), (7,), (None,)], "k long")
    out = keys_present(big, small, ["k"])
    assert sorted({r.k for r in out.collect()}) == [3, 7] and out.count() == 200
