"""Result sizes recorded in SURVEY §7.3 for sf0.01, checked on the Spark side."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF001 = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF001), reason="sf0.01 tables not present")

COUNTS = {
    "clean_dwd": 60_000,
    "page_rows": 1_413,
    "target_grid": 2_700,
    "missing_targets": 28,
    "url_lookup": 250,
    "dead_letter": 427,
    "batch_atomic": 12_714,
    "first_wins": 8_016,
    "tagged_union": 1_600,
    "stage_sanitize": 1_000,
    "stream_ingest": 750,
}


@pytest.mark.parametrize("name,rows", sorted(COUNTS.items()))
def test_row_counts(spark, name, rows):
    assert E.queries()[name](spark, SF001).count() == rows


def test_split_counts(spark):
    q = E.queries()
    acc = q["batch_atomic"](spark, SF001).groupBy("accepted").count().collect()
    assert {r["accepted"]: r["count"] for r in acc} == {True: 5_590, False: 7_124}
    assert q["url_lookup"](spark, SF001).filter(F.col("n_name").isNotNull()).count() == 45
    routed = {r["status"]: r["count"] for r in q["record_route"](spark, SF001).groupBy("status").count().collect()}
    assert routed == {"ok": 45_027, "short": 14_973}
    assert q["lenient_cast"](spark, SF001).filter(F.col("aqi").isNull()).count() == 14_973
