"""Sources and sinks: staged text, catalog tables, snapshots, streaming ingest."""

import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.schema import ODS
from skyframe.session import scratch_path
from skyframe.sources import snapshot, staged, tables


def test_staged_text_round_trip_keeps_null_and_empty(spark):
    rows = [("朝阳", "2016-01-01", "周五", "5°", "-6°", "晴\n多云", 'say "hi"', None, ""),
            ("昌平", "2016-01-02", "周六", "2°", "-8°", "a^WEAb", "x\r\x01y", "-", "优")]
    df = spark.createDataFrame(rows, ODS)
    path = staged.stage_text(df, scratch_path(spark, "t-staged"))
    back = {r.district: r for r in staged.read_staged(spark, path, ODS).collect()}
    assert back["朝阳"].weather == "晴多云"          # line break dropped
    assert back["朝阳"].wind == 'say "hi"'
    assert back["朝阳"].aqi is None and back["朝阳"].aqi_type == ""
    assert back["昌平"].weather == "a^WEAb" and back["昌平"].wind == "xy"


def test_table_modes(spark):
    db = tables.ensure_database(spark, "skyframe_test")
    name = f"{db}.t_modes"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    path = scratch_path(spark, "t-table")
    tables.write_table(df, name, mode="overwrite", path=path)
    tables.write_table(df, name, mode="append", path=path)
    assert tables.read_table(spark, name).count() == 2
    tables.write_table(df, name, mode="overwrite", path=path)
    assert tables.read_table(spark, name).count() == 1
    with pytest.raises(Exception):
        tables.write_table(df, name, mode="error", path=path)


def test_ensure_table_and_partitioned_write(spark):
    from skyframe.schema import DWD
    db = tables.ensure_database(spark, "skyframe_test")
    name = f"{db}.dwd_part"
    tables.ensure_table(spark, name, DWD, partition_by=["district"], path=scratch_path(spark, "t-dwd"))
    tables.ensure_table(spark, name, DWD, partition_by=["district"])   # exists: no-op
    assert tables.read_table(spark, name).count() == 0


def test_snapshot_verifies_and_detects_change(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    snap = snapshot.backup(orders, scratch_path(spark, "t-backup"))
    assert snapshot.restore(spark, snap).count() == orders.count()
    # tamper: an extra row lands in the data folder; the manifest no longer matches
    orders.limit(1).write.mode("append").parquet(f"{snap}/data")
    with pytest.raises(ValueError):
        snapshot.restore(spark, snap)


def test_stream_ingest_is_incremental_and_replay_safe(spark, sf_dir, tmp_path):
    from skyframe.streaming.ingest import ingest_stream
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    land = tmp_path / "landing"
    land.mkdir()
    first = ev.filter("event_id % 2 = 0")
    second = ev.filter("event_id % 2 = 1")
    first.write.parquet(str(land / "a"))
    for f in os.listdir(land / "a"):
        if f.endswith(".parquet"):
            shutil.copy(land / "a" / f, land / f"a-{f}")
    target, ckpt = str(tmp_path / "target"), str(tmp_path / "ckpt")
    src = str(land / "*.parquet")
    out1 = ingest_stream(spark, src, ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                         target=target, checkpoint=ckpt, timeout_s=300)
    n1 = out1.count()
    # a second run with nothing new changes nothing
    out2 = ingest_stream(spark, src, ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                         target=target, checkpoint=ckpt, timeout_s=300)
    assert out2.count() == n1
    # new files: only keys not stored yet are added, keys stay unique
    second.write.parquet(str(land / "b"))
    for f in os.listdir(land / "b"):
        if f.endswith(".parquet"):
            shutil.copy(land / "b" / f, land / f"b-{f}")
    out3 = ingest_stream(spark, src, ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                         target=target, checkpoint=ckpt, timeout_s=300)
    keys = out3.groupBy("user_id", "event_type").count()
    assert keys.filter("count > 1").count() == 0
    assert keys.count() == ev.select("user_id", "event_type").distinct().count()
    # first batch's rows are kept for the keys it held
    kept = out3.join(out1.select("event_id"), "event_id").count()
    assert kept == n1


def test_a_write_that_loses_or_moves_values_does_not_verify(spark, tmp_path, monkeypatch):
    import pytest
    from pyspark.sql import functions as F
    from skyframe.sources import snapshot
    df = spark.createDataFrame([(1, None), (2, 3), (None, 4)], "a int, b int")
    good = snapshot._write
    assert snapshot.restore(spark, snapshot.backup(df, str(tmp_path))).count() == 3
    for harm in (lambda d: d.filter("a IS NULL OR a <> 2"), lambda d: d.select(F.coalesce("a", "b").alias("a"), F.when(F.col("a").isNotNull(), F.col("b")).alias("b"))):
        # the observed rows are the source's; what reaches the files is not
        monkeypatch.setattr(snapshot, "_write", lambda d, p, harm=harm: (d.write.format("noop").mode("overwrite").save(), good(harm(df), p)))
        path = snapshot.backup(df, str(tmp_path))
        with pytest.raises(ValueError):
            snapshot.restore(spark, path)


def test_staged_texts_keep_blanks_and_null_marks(spark, tmp_path):
    from skyframe.sources.staged import read_staged, stage_text
    rows = [("  lead and trail  ",), (" ",), ("tab\t",), ("\\N",), ("\\N\\Nx",), ("\\Nabc",), ("",), (None,), ('say "hi"',)]
    df = spark.createDataFrame(rows, "t string")
    back = read_staged(spark, stage_text(df, str(tmp_path / "s")), df.schema)
    assert sorted(map(str, (r.t for r in back.collect()))) == sorted(str(r[0]) for r in rows)


def test_text_pages_keep_their_address(spark, tmp_path):
    from skyframe import fixed
    from skyframe.functions.scalars import url_param
    from skyframe.sources.pages import read_pages
    (tmp_path / "history?areaInfo%5BareaId%5D=60198&x=1").write_text("<tr></tr>")
    page = read_pages(spark, str(tmp_path), "text").select("url", url_param("url", fixed.AREA_KEY, fixed.AREA_ID_WIDTH).alias("area")).first()
    assert page.area == "60198"
