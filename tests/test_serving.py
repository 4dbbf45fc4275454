"""Serving tables: built once per application, rebuilt on refresh, read
back with the declared schema and column order."""

from plan_text import plan_text
from skyframe.plans import serving


def test_built_once_and_refreshed(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("2016-01-01", "001", 1.5), ("2016-01-02", "002", None)],
                                     "year_mon_day string, district string, aqi double")

    a = serving.serving_table(spark, "t-once", build)
    b = serving.serving_table(spark, "t-once", build)
    assert len(calls) == 1
    assert a.columns == ["year_mon_day", "district", "aqi"]
    assert dict(a.dtypes)["district"] == "string"          # '001' is not read back as a number
    assert sorted(r.district for r in b.collect()) == ["001", "002"]
    serving.serving_table(spark, "t-once", build, refresh=True)
    assert len(calls) == 2
    plan = plan_text(a.filter("district = '001'"))
    assert "PartitionFilters" in plan and "001" in plan


def test_a_hot_value_is_split_by_the_row_id(spark):
    import glob
    src = spark.range(0, 20_000).selectExpr("'a' AS district", "'2016-01-01' AS year_mon_day", "id")
    got = serving.serving_table(spark, "t-hot", lambda: src, spread_by=("id",))
    assert got.count() == 20_000
    path = serving._SERVED[(spark.sparkContext.applicationId, "t-hot")][0].replace("file:", "")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        serving.serving_table(spark, "t-hot", lambda: src, spread_by=("id",), refresh=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    path = serving._SERVED[(spark.sparkContext.applicationId, "t-hot")][0].replace("file:", "")
    assert len(glob.glob(path + "/district=a/*.parquet")) > 1


def test_large_tables_are_dealt_by_rows_and_staged_rows_are_not_dealt(spark, monkeypatch):
    src = spark.range(4000).selectExpr("'a' AS district", "'2016-01-01' AS year_mon_day", "id")
    monkeypatch.setattr(serving, "TASK_ROWS", 1000)
    tasks = serving.deal(src, ["district", "year_mon_day", "id"], 4000)
    assert tasks.rdd.getNumPartitions() == 4 and max(len(p) for p in tasks.rdd.glom().collect()) < 2000
    got = serving.serving_table(spark, "t-plain", lambda: src.coalesce(1), partition_by=(), sort_by=())
    assert [r.id for r in got.coalesce(1).collect()] == list(range(4000))
    again = serving.serving_table(spark, "t-dealt", lambda: tasks, dealt=True)
    assert again.count() == 4000 and len([f for f in again.inputFiles() if "district=a" in f]) == 4


def test_part_texts_are_not_shuffled_with_the_rows(spark, sf_dir):
    from skyframe.sources.adapter import observations
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(observations(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sent = [block for block in plan.split("\n\n") if ") Exchange" in block]
    assert sent and not any("p_name" in block and "l_orderkey" in block for block in sent)


def test_ranks_are_made_in_tasks_by_rows(spark, monkeypatch):
    from skyframe.plans import registry
    asked = []
    monkeypatch.setattr(registry, "dwd", lambda *_: spark.range(20_000))
    monkeypatch.setattr(registry, "global_rank", lambda df, order, name, num_partitions=None: asked.append(num_partitions) or df)
    for rows in (1000, 250_000):
        monkeypatch.setattr(registry, "TASK_ROWS", rows)
        registry.q_sorted_rank(spark, "")
    assert asked == [20, int(spark.conf.get("spark.sql.shuffle.partitions"))]
