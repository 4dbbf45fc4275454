"""Bad staged lines: their rules, their bytes, and the good rows beside them."""

import os
from collections import Counter
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from skyframe.session import scratch_path
from skyframe.sources.quarantine import load_quarantined

SCHEMA = T.StructType([T.StructField("day", T.StringType()), T.StructField("aqi", T.IntegerType()), T.StructField("note", T.StringType())])


def _line(i: int) -> tuple[str, str | None]:
    if i % 97 == 0:
        return f"2016-{i}", "arity"
    if i % 97 == 1:
        return f"2016-{i}^WEA{i}^WEAü^WEAmore", "arity"
    if i % 101 == 0:
        return f"2016-{i}^WEAviel^WEAläng{'e' * (i % 300)}", "type"
    if i % 103 == 0:
        return f"2016-{i}^WEA-5^WEAx", "positive"
    if i % 107 == 0:
        return f"2016-{i}^WEA\\N^WEAx", "positive"
    if i % 109 == 0:
        return "", None
    return f"2016-{i}^WEA{i + 1}^WEA{('晴', chr(92) + 'N', chr(92) * 1 + 'N' + chr(92) + 'N', chr(34) + 'a ^WEA b' + chr(34))[i % 4]}", None


@pytest.mark.parametrize("block", [700, 1 << 27])
def test_bad_lines_are_found_at_their_bytes(spark, block):
    folder = scratch_path(spark, "quarantine-text").removeprefix("file:")
    os.makedirs(folder)
    lines = [_line(i) for i in range(1, 4000)]
    for part in range(3):
        with open(f"{folder}/part {part}.csv", "w", newline="") as f:
            f.write("\n".join(t for t, _ in lines[part::3]) + ("\n" if part else ""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = load_quarantined(spark, folder, SCHEMA, scratch_path(spark, "quarantine-out"), rules={"positive": F.col("aqi") > 0})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rejects = got.rejects.collect()
    assert Counter((r.line, r.rule) for r in rejects) == Counter((t, w) for t, w in lines if w)
    for r in rejects:
        with open(unquote(urlparse(r.file).path), "rb") as f:
            f.seek(r.place)
            assert f.read(len(r.line.encode())) == r.line.encode()
    assert {r.rule: r.n for r in got.counts.collect()} == Counter(w for _, w in lines if w)
    want = [(f"2016-{i}", i + 1, ("晴", None, "\\N", "a ^WEA b")[i % 4]) for i in range(1, 4000) if _line(i)[1] is None and _line(i)[0]]
    assert sorted(map(tuple, got.good.collect()), key=lambda r: r[1]) == want


def test_nothing_staged_and_clashing_names(spark):
    path = scratch_path(spark, "quarantine-none")
    spark.createDataFrame([], "value string").write.text(path)
    got = load_quarantined(spark, path, SCHEMA, scratch_path(spark, "quarantine-out"))
    assert got.good.collect() == got.rejects.collect() == got.counts.collect() == []
    with pytest.raises(ValueError, match="_line"):
        load_quarantined(spark, path, T.StructType([T.StructField("_line", T.StringType())]), scratch_path(spark, "quarantine-out"))
