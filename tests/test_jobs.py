"""The batch jobs end to end on invented pages: collect -> merge -> load and
clean -> dashboard panels."""

import json

from skyframe import fixed
from skyframe.plans import dashboard as D
from skyframe.plans.jobs import collect_job, load_clean_job, merge_job
from skyframe.session import scratch_path
from skyframe.sources.tables import ensure_database

HEADER = "<tr><th>日期</th><th>最高温</th><th>最低温</th><th>天气</th><th>风力风向</th><th>空气质量指数</th></tr>"


def _page(area, year, month, rows):
    url = fixed.URL_TEMPLATE.format(base="http://h/x", area=area, year=year, month=month)
    cells = "".join(f"<tr><td>{d} {w}</td><td>{hi}°</td><td>{lo}°</td><td>{wx}</td><td>{wd}</td>"
                    f"<td><span>{aq}</span></td></tr>" for d, w, hi, lo, wx, wd, aq in rows)
    html = json.dumps({"code": 1, "data": f"<table>{HEADER}{cells}</table>"}, ensure_ascii=True).replace("/", "\\/")
    return url, html


def test_collect_merge_clean_dashboard(spark):
    db = ensure_database(spark, "skyframe_jobs")
    p1 = _page("60198", 2016, 1, [("2016-01-01", "周五", 5, -6, "晴", "西北风3级", "42 优"),
                                  ("2016-01-02", "周六", 4, -7, "多云", "无持续风向微风", "-")])
    p2 = _page("71141", 2016, 1, [("2016-01-01", "周五", 6, -5, "霾", "北风2级", "180 中度污染")])
    p3 = _page("60198", 2017, 1, [("2017-01-02", "周一", 3, -8, "晴", "东北风1级", "60 良")])
    pages = spark.createDataFrame([p1, p2], "url string, html string")
    target = f"{db}.obs"
    path = scratch_path(spark, "jobs-obs")
    rejected = collect_job(spark, pages, target, path=path)
    assert rejected.count() == 0
    # re-sending a page is rejected whole (its dates are stored); a new page lands
    again = spark.createDataFrame([p1, p3], "url string, html string")
    rejected = collect_job(spark, again, target, path=path)
    assert rejected.select("url").distinct().count() == 1
    obs = spark.table(target)
    assert obs.count() == 4

    # per-district views merged into one tagged table
    for d in ("昌平", "朝阳"):
        obs.filter(obs.district == d).drop("district").createOrReplaceTempView(f"`v_{d}`")
    merged = f"{db}.merged"
    merge_job(spark, ["v_昌平", "v_朝阳"], merged, tag_col="tag", path=scratch_path(spark, "jobs-merged"))
    assert spark.table(merged).count() == 4

    dwd_name = f"{db}.dwd"
    load_clean_job(spark, target, dwd_name, path=scratch_path(spark, "jobs-dwd"))
    dwd = spark.table(dwd_name)
    r = {(x.district, x.year_mon_day): x for x in dwd.collect()}
    # the missing AQI of 01-02 is filled from the same calendar day of other years
    assert r[("昌平", "2016-01-02")].aqi == 60.0 and r[("昌平", "2016-01-02")].aqi_type == "良"

    assert sorted(tuple(x) for x in D.data_table(dwd, "昌平区", "2016", ["最高温", "空气质量"]).collect()) == \
        [(4, "良"), (5, "优")]
    assert D.trend_panel(dwd, "昌平区", "2016-01").count() == 2
    assert D.map_panel(dwd, "2016-01-01").count() == 2
    pie = D.pie_panel(dwd, "朝阳区", "2016-01-01")
    assert pie["day"].first().weather == "霾" and pie["shares"].first().share == 1.0
    par = D.parallel_panel(dwd, "昌平区", "")
    assert par["series"].count() == 3 and par["extents"].first().aqi_hi == 60.0
    assert {x.weather: x.avg_aqi for x in D.bar_panel(dwd, "昌平区", "").collect()} == {"晴": 51.0, "多云": 60.0}


def test_command_line(spark, tmp_path):
    from skyframe.__main__ import main
    p1 = _page("60198", 2016, 1, [("2016-01-01", "周五", 5, -6, "晴", "西北风3级", "42 优")])
    p2 = _page("60198", 2017, 1, [("2017-01-01", "周日", 3, -8, "多云", "东风1级", "-")])
    pages = str(tmp_path / "pages")
    spark.createDataFrame([p1, p2], "url string, html string").write.parquet(pages)
    db = ensure_database(spark, "skyframe_cli")
    assert main(["collect", "--pages", pages, "--table", f"{db}.obs", "--path", str(tmp_path / "obs"),
                 "--rejected", str(tmp_path / "rej")]) == 0
    assert main(["clean", "--ods", f"{db}.obs", "--dwd", f"{db}.dwd", "--path", str(tmp_path / "dwd")]) == 0
    out = str(tmp_path / "view")
    assert main(["view", "--dwd", f"{db}.dwd", "--view", "table", "--place", "昌平区", "--period", "2017",
                 "--labels", "空气质量指数", "空气质量", "--out", out]) == 0
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(42.0, "优")]
    assert main(["view", "--dwd", f"{db}.dwd", "--view", "bar", "--place", "昌平区", "--show", "5"]) == 0


def test_stage_then_clean(spark, tmp_path):
    from skyframe.plans.jobs import stage_job
    from skyframe.schema import ODS
    rows = [("朝阳", "2016-01-01", "周五", "5°", "-6°", "晴\n", "西北风", "42", "优"),
            ("朝阳", "2017-01-01", "周日", "3°", "-5°", "霾", "无", "43", None),
            ("朝阳", "2018-01-01", "周一", "4°", "-6°", "晴", "北风", "", "")]
    src = spark.createDataFrame(rows, ODS)
    db = ensure_database(spark, "skyframe_stage")
    stage_job(spark, src, str(tmp_path / "ods"), f"{db}.ods")
    stage_job(spark, src, str(tmp_path / "ods"), f"{db}.ods")          # full refresh: no doubling
    ods = spark.table(f"{db}.ods")
    assert ods.count() == 3 and ods.filter("weather = '晴'").count() == 2
    load_clean_job(spark, f"{db}.ods", f"{db}.dwd2", path=str(tmp_path / "dwd"))
    got = {r.year_mon_day: r.aqi for r in spark.table(f"{db}.dwd2").collect()}
    assert got == {"2016-01-01": 42.0, "2017-01-01": 43.0, "2018-01-01": 42.0}


def test_dead_letters_command(spark, tmp_path):
    from skyframe.__main__ import main
    rows = [("u1", 1, 403), ("u1", 2, 200),          # retried fine
            ("u2", 1, 403), ("u2", 2, 403),          # retry failed
            ("u3", 1, 403),                          # never retried
            ("u4", 1, 500)]                          # other errors are not retried
    spark.createDataFrame(rows, "url string, ts int, status int").createOrReplaceTempView("attempts_t")
    out = str(tmp_path / "dead")
    assert main(["deadletters", "--attempts", "attempts_t", "--out", out]) == 0
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["u2", "u3"]


def test_bucketed_store_check_shuffles_only_incoming(spark):
    from plan_text import plan_text
    from skyframe.operators.joins import keys_present
    db = ensure_database(spark, "skyframe_bucket")
    pages = spark.createDataFrame([
        _page("60198", 2016, 1, [("2016-01-01", "周五", 5, -6, "晴", "北风", "42 优")]),
        _page("71141", 2016, 1, [("2016-01-01", "周五", 6, -5, "霾", "北风", "50 优")])], "url string, html string")
    store = f"{db}.obs_b"
    path = scratch_path(spark, "bucket-store")
    collect_job(spark, pages, store, path=path, buckets=4)
    again = spark.createDataFrame([
        _page("60198", 2016, 1, [("2016-01-01", "周五", 5, -6, "晴", "北风", "42 优")]),
        _page("60198", 2016, 2, [("2016-02-01", "周一", 5, -6, "晴", "北风", "42 优")])], "url string, html string")
    rejected = collect_job(spark, again, store, path=path, buckets=4)
    assert spark.table(store).count() == 3 and rejected.select("url").distinct().count() == 1
    incoming = spark.table(store).select("district", "year_mon_day").limit(2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(keys_present(spark.table(store).select("district", "year_mon_day"), incoming,
                                      ["district", "year_mon_day"]), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1        # the incoming side only
