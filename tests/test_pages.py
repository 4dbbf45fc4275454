"""Raw pages -> records -> routed rows, on invented pages shaped like the
collected history payload (escaped closers, \\uXXXX text)."""

import json

from skyframe.operators.ingest import route_records
from skyframe.sources.pages import page_records

HEADER = "<tr><th>日期</th><th>最高温</th><th>最低温</th><th>天气</th><th>风力风向</th><th>空气质量指数</th></tr>"
ROW1 = ('<tr><td>2016-01-01 周五</td><td style="color:#ff5040;">5°</td><td style="color:#3097fd;">-6°</td>'
        '<td>晴</td><td>西北风3级</td><td><span class="history-aqi wea-aqi-1">42 优</span></td></tr>')
ROW2 = ("<tr><td>2016-01-02 周六</td><td>4°</td><td>-7°</td><td>多云</td><td>无持续风向微风</td>"
        "<td><span>-</span></td></tr>")


def escaped(markup: str) -> str:
    return json.dumps(markup, ensure_ascii=True)[1:-1].replace("/", "\\/")


def test_escaped_envelope_and_plain_pages(spark):
    table = f"<table>{HEADER}{ROW1}{ROW2}</table>"
    pages = [
        ("u-envelope", json.dumps({"code": 1, "msg": "", "data": table}, ensure_ascii=True).replace("/", "\\/")),
        ("u-escaped", escaped(table)),
        ("u-plain", table),
        ("u-header-only", f"<table>{HEADER}</table>"),
        ("u-empty", "<html>no data</html>"),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    recs = {(r.url, r.row_no): r.record for r in page_records(df).collect()}
    want1 = "2016-01-01,周五,5°,-6°,晴,西北风3级,42,优"
    want2 = "2016-01-02,周六,4°,-7°,多云,无持续风向微风,-"
    for u in ("u-envelope", "u-escaped", "u-plain"):
        assert recs[(u, 1)] == want1, u
        assert recs[(u, 2)] == want2, u
    assert not any(k[0] in ("u-header-only", "u-empty") for k in recs)


def test_records_route(spark):
    table = f"<table>{HEADER}{ROW1}{ROW2}</table>"
    df = spark.createDataFrame([("u", escaped(table))], "url string, html string")
    routed = route_records(page_records(df)).orderBy("row_no").collect()
    assert [(r.status, r.year_mon_day, r.wind, r.aqi) for r in routed] == [
        ("ok", "2016-01-01", "西北风", "42"), ("short", "2016-01-02", "无", None)]


def _url(area, year, month):
    from skyframe import fixed
    return fixed.URL_TEMPLATE.format(base="http://h/x", area=area, year=year, month=month)


def test_ingest_pages_batch_atomic(spark):
    from skyframe.operators.ingest import ingest_pages
    from skyframe.schema import ODS

    def page(rows):
        return escaped(f"<table>{HEADER}{''.join(rows)}</table>")

    def row(day, wk, aqi="42 优"):
        return (f"<tr><td>{day} {wk}</td><td>5°</td><td>-6°</td><td>晴</td><td>北风2级</td>"
                f"<td><span>{aqi}</span></td></tr>")

    pages = [
        (_url("60198", 2016, 1), page([row("2016-01-01", "周五"), row("2016-01-02", "周六", "-")])),  # ok
        (_url("60198", 2016, 2), page([row("2016-02-01", "周一"), "<tr><td>2016-02-02</td><td>x</td></tr>"])),  # bad row
        (_url("71141", 2016, 1), page([row("2016-01-01", "周五")])),     # other district, same date: ok
        (_url("71141", 2016, 3), page([row("2016-03-01", "周二")])),     # date already stored
        (_url("99999", 2016, 1), page([row("2016-01-01", "周五")])),     # unknown area
        (_url("60198", 2016, 4), page([row("2016-04-01", "周五"), row("2016-04-01", "周五")])),  # dup date
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    target = spark.createDataFrame([("朝阳", "2016-03-01", "周二", "1°", "0°", "晴", "无", "1", "优")], ODS)
    acc, rej = ingest_pages(df, target)
    got = sorted((r.district, r.year_mon_day, r.wind, r.aqi) for r in acc.collect())
    assert got == [("昌平", "2016-01-01", "北风", "42"), ("昌平", "2016-01-02", "北风", None),
                   ("朝阳", "2016-01-01", "北风", "42")]
    assert acc.columns == list(ODS.fieldNames())
    assert rej.select("url").distinct().count() == 4


def test_dead_letter_text_sink(spark, tmp_path):
    from skyframe.operators.ingest import write_dead_letters
    df = spark.createDataFrame([("http://a",), ("http://b",), ("http://b",)], "url string")
    path = str(tmp_path / "dead")
    write_dead_letters(df, path)
    write_dead_letters(df.limit(1), path)      # appends
    assert spark.read.text(path).count() == 3


def test_read_pages_from_landed_files(spark, tmp_path):
    from skyframe.sources.pages import read_pages
    table = f"<table>{HEADER}{ROW1}{ROW2}</table>"
    (tmp_path / "p1.html").write_text(escaped(table), encoding="utf-8")
    (tmp_path / "p2.html").write_text(f"<table>{HEADER}</table>", encoding="utf-8")
    pages = read_pages(spark, str(tmp_path / "*.html"), fmt="text")
    recs = page_records(pages).collect()
    assert len(recs) == 2 and all(r.url.endswith("p1.html") for r in recs)


def test_page_stream_lands_waves_key_unique(spark, tmp_path):
    from skyframe.streaming.ingest import ingest_pages_stream

    def page(day, wk, aqi="42 优"):
        return escaped(f"<table>{HEADER}<tr><td>{day} {wk}</td><td>5°</td><td>-6°</td><td>晴</td>"
                       f"<td>北风2级</td><td><span>{aqi}</span></td></tr></table>")

    land = tmp_path / "land"
    wave1 = [(_url("60198", 2016, 1), page("2016-01-01", "周五")),
             (_url("71141", 2016, 1), page("2016-01-01", "周五"))]
    wave2 = [(_url("60198", 2016, 1), page("2016-01-01", "周五")),   # re-sent: rejected whole
             (_url("60198", 2016, 2), page("2016-02-01", "周一"))]
    spark.createDataFrame(wave1, "url string, html string").coalesce(1).write.parquet(str(land / "w1"))
    kw = dict(target=str(tmp_path / "t"), rejected=str(tmp_path / "r"), checkpoint=str(tmp_path / "c"),
              timeout_s=300)
    src = str(land / "*" / "*.parquet")
    stored, _ = ingest_pages_stream(spark, src, **kw)
    assert stored.count() == 2
    spark.createDataFrame(wave2, "url string, html string").coalesce(1).write.parquet(str(land / "w2"))
    stored, rej = ingest_pages_stream(spark, src, **kw)
    got = sorted((r.district, r.year_mon_day) for r in stored.collect())
    assert got == [("昌平", "2016-01-01"), ("昌平", "2016-02-01"), ("朝阳", "2016-01-01")]
    assert rej.select("url").distinct().count() == 1
