"""Named queries over the shared test tables, each with the DuckDB SQL that
must give the same rows.

Weather-shaped queries run on the observation view derived from
lineitem/part/supplier/nation/region (``sources.adapter``) and on its
cleaned form ``dwd``; ingestion queries run on pages, orders, events,
customer, supplier and documents.  Every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalars import domain_ordinal, leading_token, url_param
from ..operators import charts, clean as C, ingest, query as Q
from ..operators.ranking import global_rank
from ..schema import ODS
from ..session import scratch_path
from ..sources import grid, pages as P, snapshot, staged, tables
from ..sources.adapter import OBS_SQL, ROW_ID, observations, read_table
from ..streaming.ingest import ingest_stream
from . import dashboard
from .serving import TASK_ROWS, deal, serving_table

ALL_LABELS = ["最高温", "最低温", "天气", "风向", "空气质量指数", "空气质量"]
DAY = "1997-03-03"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    """Record a query under ``name`` with its DuckDB oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def ods(spark: SparkSession, sf: str) -> DataFrame:
    """The staged (ODS) table: the source rows landed once per application,
    so cleaning reads a table instead of re-running the source joins."""
    return serving_table(spark, f"ods:{sf}", lambda: observations(spark, sf), partition_by=(), sort_by=())


def fresh_dwd(spark: SparkSession, sf: str) -> DataFrame:
    """The clean job itself, from the staged rows."""
    return C.clean(ods(spark, sf), keep=ROW_ID)


def dwd(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned table as dashboards read it: built once per application."""
    def build():
        staged = ods(spark, sf)
        rows = staged.count()
        return C.clean(staged, keep=ROW_ID, deal=lambda df: deal(df, ["district", "year_mon_day", *ROW_ID], rows))

    return serving_table(spark, f"dwd:{sf}", build, dealt=True)


# ---------------------------------------------------------------- oracle CTEs

_BANDS_SQL = ("CASE WHEN {v} IS NULL THEN NULL WHEN {v} <= 50 THEN '优' WHEN {v} <= 100 THEN '良' "
              "WHEN {v} <= 150 THEN '轻度污染' WHEN {v} <= 200 THEN '中度污染' "
              "WHEN {v} <= 300 THEN '重度污染' ELSE '严重污染' END")

WITH_OBS = f"WITH obs AS ({OBS_SQL})"
WITH_TYPED = WITH_OBS + """,
typed AS (
  SELECT district, year_mon_day, week,
         CAST(replace(max_t, '°', '') AS INTEGER) AS max_t,
         CAST(replace(min_t, '°', '') AS INTEGER) AS min_t,
         weather, wind,
         CASE WHEN isnan(TRY_CAST(aqi AS DOUBLE)) THEN NULL ELSE TRY_CAST(aqi AS DOUBLE) END AS aqi0,
         l_orderkey, l_linenumber
  FROM obs),
filled AS (
  SELECT *, round_even(coalesce(aqi0, avg(aqi0) OVER (PARTITION BY district, substr(year_mon_day, 6, 5))), 0) AS aqi
  FROM typed)"""
WITH_DWD = WITH_TYPED + f""",
dwd AS (
  SELECT district, year_mon_day, week, max_t, min_t, weather, wind, aqi,
         {_BANDS_SQL.format(v='aqi')} AS aqi_type, l_orderkey, l_linenumber
  FROM filled)"""

MEAN_T = "(CAST(max_t AS DOUBLE) + CAST(min_t AS DOUBLE)) / 2.0"
PIECES_SQL = ("CASE WHEN mean_t BETWEEN 31 AND 40 THEN '30~40℃' WHEN mean_t BETWEEN 21 AND 30 THEN '20~30℃' "
              "WHEN mean_t BETWEEN 11 AND 20 THEN '10~20℃' WHEN mean_t BETWEEN 1 AND 10 THEN '0~10℃' "
              "WHEN mean_t BETWEEN -10 AND 0 THEN '-10~0℃' ELSE NULL END")
DWD_COLS = "district, year_mon_day, week, max_t, min_t, weather, wind, aqi, aqi_type, l_orderkey, l_linenumber"


# ------------------------------------------------------------------ cleaning

@register("clean_dwd", WITH_DWD + f"\nSELECT {DWD_COLS} FROM dwd")
def q_clean_dwd(spark, sf):
    return fresh_dwd(spark, sf)


@register("strict_cast", WITH_TYPED + "\nSELECT l_orderkey, l_linenumber, max_t, min_t FROM typed")
def q_strict_cast(spark, sf):
    return C.cast_temperatures(ods(spark, sf)).select(*ROW_ID, "max_t", "min_t")


@register("lenient_cast", WITH_TYPED + "\nSELECT l_orderkey, l_linenumber, aqi0 AS aqi FROM typed")
def q_lenient_cast(spark, sf):
    return C.cast_aqi(ods(spark, sf)).select(*ROW_ID, "aqi")


_ODD_SQL = ("CASE l_linenumber % 7 WHEN 0 THEN aqi || 'd' WHEN 1 THEN '0x' || aqi || 'p3' WHEN 2 THEN ' ' || aqi || ' ' "
            "WHEN 3 THEN aqi || '.5e1' WHEN 4 THEN 'NaN' WHEN 5 THEN aqi || 'f' ELSE aqi END")


@register("lenient_cast_text", WITH_OBS + f""", t AS (SELECT l_orderkey, l_linenumber, {_ODD_SQL} AS text FROM obs)
SELECT l_orderkey, l_linenumber, text,
       CASE WHEN regexp_full_match(trim(text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[0-9]+)?') THEN CAST(trim(text) AS DOUBLE) END AS aqi
FROM t""")
def q_lenient_cast_text(spark, sf):
    o, n = ods(spark, sf), F.col("l_linenumber") % 7
    text = (F.when(n == 0, F.concat("aqi", F.lit("d"))).when(n == 1, F.concat(F.lit("0x"), "aqi", F.lit("p3")))
             .when(n == 2, F.concat(F.lit(" "), "aqi", F.lit(" "))).when(n == 3, F.concat("aqi", F.lit(".5e1")))
             .when(n == 4, F.lit("NaN")).when(n == 5, F.concat("aqi", F.lit("f"))).otherwise(F.col("aqi")))
    odd = o.select(*ROW_ID, text.alias("text"), text.alias("aqi"))
    return C.cast_aqi(odd)


@register("impute_mean", WITH_TYPED + "\nSELECT l_orderkey, l_linenumber, district, year_mon_day, aqi FROM filled")
def q_impute_mean(spark, sf):
    df = C.impute_group_mean(C.cast_aqi(ods(spark, sf)))
    return df.select(*ROW_ID, "district", "year_mon_day", "aqi")


@register("band_classify", WITH_TYPED + f"\nSELECT l_orderkey, l_linenumber, aqi0 AS aqi, "
          f"{_BANDS_SQL.format(v='aqi0')} AS aqi_type FROM typed")
def q_band_classify(spark, sf):
    df = C.classify_aqi(C.cast_aqi(ods(spark, sf)))
    return df.select(*ROW_ID, "aqi", "aqi_type")


# lineitem repeats some (l_orderkey, l_linenumber) pairs: the other columns break ties
TIE_BREAK = ["max_t", "min_t", "weather", "wind", "aqi"]
_RANK_ORDER = ["district", "year_mon_day", *ROW_ID, *TIE_BREAK]


@register("sorted_rank", WITH_DWD + f"\nSELECT {DWD_COLS}, row_number() OVER "
          f"(ORDER BY {', '.join(_RANK_ORDER)}) AS row_rank FROM dwd")
def q_sorted_rank(spark, sf):
    # C6 orders the cleaned rows: rank the stored DWD table
    cleaned = dwd(spark, sf)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), cleaned.count() // TASK_ROWS)
    return global_rank(cleaned, _RANK_ORDER, name="row_rank", num_partitions=tasks)


# ---------------------------------------------------------------- selections

def _labels_sql(labels):
    return ", ".join(f'{fixed.LABEL_COLUMNS[lab]} AS "{lab}"' for lab in labels)


@register("select_all", WITH_DWD + f"\nSELECT {_labels_sql(ALL_LABELS)} FROM dwd WHERE district = 'ASIA'")
def q_select_all(spark, sf):
    return Q.select_fields(dwd(spark, sf), "ASIA区", "", ALL_LABELS)


_Y_LABELS = ["最高温", "天气", "空气质量"]


@register("select_year", WITH_DWD + f"\nSELECT {_labels_sql(_Y_LABELS)} FROM dwd "
          "WHERE district = 'EUROPE' AND substr(year_mon_day, 1, 4) = '1996'")
def q_select_year(spark, sf):
    return Q.select_fields(dwd(spark, sf), "EUROPE区", "1996", _Y_LABELS)


_M_LABELS = ["最低温", "风向", "空气质量指数"]


@register("select_month", WITH_DWD + f"\nSELECT {_labels_sql(_M_LABELS)} FROM dwd "
          "WHERE district = 'AMERICA' AND substr(year_mon_day, 1, 7) = '1997-03'")
def q_select_month(spark, sf):
    return Q.select_fields(dwd(spark, sf), "AMERICA区", "1997-03", _M_LABELS)


@register("select_day", WITH_DWD + f"\nSELECT {_labels_sql(ALL_LABELS)} FROM dwd "
          f"WHERE district = 'MIDDLE EAST' AND substr(year_mon_day, 1, 10) = '{DAY}'")
def q_select_day(spark, sf):
    return Q.select_fields(dwd(spark, sf), "MIDDLE EAST区", DAY, ALL_LABELS)


def _trend_sql(place, cond):
    return WITH_DWD + (f"\nSELECT year_mon_day, max_t, min_t, {MEAN_T} AS mean_t FROM dwd "
                       f"WHERE district = '{place}'{cond}")


@register("trend_month", _trend_sql("ASIA", " AND substr(year_mon_day, 1, 7) = '1996-05'"))
def q_trend_month(spark, sf):
    return charts.trend(dwd(spark, sf), "ASIA区", "1996-05")


@register("trend_year", _trend_sql("AFRICA", " AND substr(year_mon_day, 1, 4) = '1999'"))
def q_trend_year(spark, sf):
    return charts.trend(dwd(spark, sf), "AFRICA区", "1999")


@register("trend_all", _trend_sql("MIDDLE EAST", ""))
def q_trend_all(spark, sf):
    return charts.trend(dwd(spark, sf), "MIDDLE EAST区", "")


@register("day_weather", WITH_DWD + "\nSELECT district, year_mon_day, weather FROM dwd "
          f"WHERE district = 'EUROPE' AND year_mon_day = '{DAY}'")
def q_day_weather(spark, sf):
    return Q.day_weather(dwd(spark, sf), "EUROPE区", DAY)


@register("day_slice", WITH_DWD + "\nSELECT district, max_t, min_t, aqi FROM dwd "
          f"WHERE district = 'AMERICA' AND year_mon_day = '{DAY}'")
def q_day_slice(spark, sf):
    return Q.day_slice(dwd(spark, sf), "AMERICA区", DAY)


@register("multi_range", WITH_DWD + f"\nSELECT {DWD_COLS} FROM dwd WHERE district IN ('ASIA', 'EUROPE') "
          "AND year_mon_day BETWEEN '1996-01-01' AND '1996-06-30'")
def q_multi_range(spark, sf):
    d = Q.in_districts(dwd(spark, sf), ["ASIA区", "EUROPE区"])
    return Q.between_days(d, "1996-01-01", "1996-06-30")


@register("sql_join", WITH_DWD + """
SELECT r.r_regionkey, d.district, count(*) AS n, avg(d.aqi) AS avg_aqi, max(d.max_t) AS max_max_t
FROM dwd d JOIN region r ON d.district = r.r_name
GROUP BY r.r_regionkey, d.district""")
def q_sql_join(spark, sf):
    Q.register_views(spark, {"sf_dwd": dwd(spark, sf), "sf_region": read_table(spark, sf, "region")})
    return spark.sql("""
        SELECT r.r_regionkey, d.district, count(*) AS n, avg(d.aqi) AS avg_aqi, max(d.max_t) AS max_max_t
        FROM sf_dwd d JOIN sf_region r ON d.district = r.r_name
        GROUP BY r.r_regionkey, d.district""")


# --------------------------------------------------------------- chart data

@register("avg_temp", WITH_DWD + f"\nSELECT district, avg({MEAN_T}) AS avg_t FROM dwd GROUP BY district")
def q_avg_temp(spark, sf):
    return charts.avg_temp(dwd(spark, sf))


@register("timeline", WITH_DWD + "\nSELECT DISTINCT year_mon_day FROM dwd")
def q_timeline(spark, sf):
    return charts.timeline(dwd(spark, sf))


_MAP_SQL = f"SELECT year_mon_day, district || '区' AS area, {MEAN_T} AS mean_t FROM dwd"


@register("map_frame", WITH_DWD + "\n" + _MAP_SQL)
def q_map_frame(spark, sf):
    return charts.map_frame(dwd(spark, sf))


@register("map_piece", WITH_DWD + f",\nm AS ({_MAP_SQL})\nSELECT *, {PIECES_SQL} AS piece FROM m")
def q_map_piece(spark, sf):
    return charts.map_piece(dwd(spark, sf))


@register("map_timeline", WITH_DWD + f",\nm AS ({_MAP_SQL})\nSELECT *, {PIECES_SQL} AS piece, "
          "CAST(dense_rank() OVER (ORDER BY year_mon_day) AS INTEGER) AS frame FROM m")
def q_map_timeline(spark, sf):
    return charts.map_timeline(dwd(spark, sf))


@register("category_counts", WITH_DWD + "\nSELECT weather, count(*) AS n FROM dwd GROUP BY weather")
def q_category_counts(spark, sf):
    return charts.category_counts(dwd(spark, sf))


@register("category_share", WITH_DWD + "\nSELECT weather, count(*) AS n, "
          "count(*) / sum(count(*)) OVER () AS share FROM dwd GROUP BY weather")
def q_category_share(spark, sf):
    return charts.category_share(dwd(spark, sf))


@register("extents", WITH_DWD + "\nSELECT max(max_t) AS max_t_hi, min(max_t) AS max_t_lo, max(min_t) AS min_t_hi, "
          "min(min_t) AS min_t_lo, max(aqi) AS aqi_hi, min(aqi) AS aqi_lo FROM dwd")
def q_extents(spark, sf):
    return charts.extents(dwd(spark, sf))


@register("distinct_values", WITH_DWD + "\nSELECT DISTINCT wind FROM dwd")
def q_distinct_values(spark, sf):
    return charts.distinct_values(dwd(spark, sf), "wind")


_CLASS_POS = ("CASE aqi_type WHEN '优' THEN 1 WHEN '良' THEN 2 WHEN '轻度污染' THEN 3 WHEN '中度污染' THEN 4 "
              "WHEN '重度污染' THEN 5 WHEN '严重污染' THEN 6 END")


@register("class_series", WITH_DWD + f"\nSELECT {DWD_COLS}, {_CLASS_POS} AS class_no FROM dwd "
          "WHERE aqi_type IS NOT NULL")
def q_class_series(spark, sf):
    return charts.class_series(dwd(spark, sf))


@register("class_pivot", WITH_DWD + "\nSELECT " + ", ".join(
    f"count(*) FILTER (WHERE aqi_type = '{c}') AS \"{c}\"" for c in fixed.AQI_CLASSES) + " FROM dwd")
def q_class_pivot(spark, sf):
    return charts.class_pivot(dwd(spark, sf))


@register("domain_ordinal", WITH_DWD + f"\nSELECT l_orderkey, l_linenumber, aqi_type, {_CLASS_POS} AS class_no, "
          "wind, CAST(NULLIF(list_position(" + "[" + ", ".join(f"'{w}'" for w in fixed.WIND_DOMAIN) + "]"
          ", wind), 0) AS INTEGER) AS wind_no FROM dwd")
def q_domain_ordinal(spark, sf):
    d = dwd(spark, sf)
    return d.select(*ROW_ID, "aqi_type", domain_ordinal("aqi_type", fixed.AQI_CLASSES).alias("class_no"),
                    "wind", domain_ordinal("wind", fixed.WIND_DOMAIN).alias("wind_no"))


@register("category_mean", WITH_DWD + "\nSELECT weather, round_even(avg(aqi), 2) AS avg_aqi FROM dwd GROUP BY weather")
def q_category_mean(spark, sf):
    return charts.category_mean(dwd(spark, sf))


@register("rollup_period", WITH_DWD + """
SELECT district, substr(year_mon_day, 1, 7) AS period, avg(max_t) AS avg_max_t, avg(min_t) AS avg_min_t,
       max(max_t) AS max_max_t, min(min_t) AS min_min_t, avg(aqi) AS avg_aqi, count(*) AS n
FROM dwd GROUP BY district, substr(year_mon_day, 1, 7)""")
def q_rollup_period(spark, sf):
    return charts.rollup_period(dwd(spark, sf), "month")


@register("rollup_year", WITH_DWD + """
SELECT district, substr(year_mon_day, 1, 4) AS period, avg(max_t) AS avg_max_t, avg(min_t) AS avg_min_t,
       max(max_t) AS max_max_t, min(min_t) AS min_min_t, avg(aqi) AS avg_aqi, count(*) AS n
FROM dwd GROUP BY district, substr(year_mon_day, 1, 4)""")
def q_rollup_year(spark, sf):
    return charts.rollup_period(dwd(spark, sf), "year")


# -------------------------------------------------------- extraction, ingest

_LINK_RE = '<a href="([^"]*)">'


@register("page_rows", f"""
SELECT page_id, CAST(generate_subscripts(regexp_extract_all(html, '{_LINK_RE}', 1), 1) AS INTEGER) AS row_no,
       unnest(regexp_extract_all(html, '{_LINK_RE}', 1)) AS row_html
FROM pages""")
def q_page_rows(spark, sf):
    pg = read_table(spark, sf, "pages", spread_on=["page_id"])
    return P.extract_rows(pg, keys=("page_id",), row_re=_LINK_RE, skip_header=False, decode=False)


_ROW = "<tr><td>%s %s</td><td>%s°</td><td>%s°</td><td>晴</td><td>%s</td><td>%s</td></tr>"
_FETCHED = "http://weather.example/history?areaInfo%5BareaId%5D=%05d&areaInfo%5BareaType%5D=2&date%5Byear%5D=%d&date%5Bmonth%5D=1&try=%d"
_DAY_WIND = ["东北风3级", "西风", "南风微风"]


def _fetched_pages(spark, sf):
    """A page per customer and year with a row per order date.  Every fifth customer's pages come
    broken first and whole on the second try, every seventh one's are fetched twice."""
    d = F.col("d")
    day = F.dayofmonth(d)
    aqi = F.when(day % 4 == 0, F.lit("-")).otherwise(F.concat((day * 10).cast("string"), F.lit(" 良")))
    week = F.element_at(F.array(*[F.lit(w) for w in fixed.WEEKDAYS]), F.dayofweek(d))
    wind = F.element_at(F.array(*[F.lit(w) for w in _DAY_WIND]), day % 3 + 1)
    rows = (read_table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("date").alias("d")).distinct()
            .select("k", F.year(d).alias("y"), "d", F.format_string(_ROW, F.date_format(d, "yyyy-MM-dd"), week, day, day - F.month(d), wind, aqi).alias("row")))
    pages = rows.groupBy("k", "y").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("d", "row"))), lambda r: r["row"]), "\n").alias("rows"))
    tries = F.when((F.col("k") % 5 == 0) | (F.col("k") % 7 == 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    pages = pages.withColumn("n", F.explode(tries))
    broken = F.when((F.col("k") % 5 == 0) & (F.col("n") == 1), F.lit("<tr><td>error</td></tr>")).otherwise(F.lit(""))
    head = "<table><tr>" + "".join(f"<th>{h}</th>" for h in fixed.PAGE_HEADER) + "</tr>"
    html = F.to_json(F.struct(F.concat(F.lit(head), "rows", broken, F.lit("</table>")).alias("data")))
    url = F.format_string(_FETCHED.replace("%5B", "%%5B").replace("%5D", "%%5D"), "k", "y", "n")
    return pages.select(url.alias("url"), html.alias("html"))


def _customer_areas(spark, sf):
    """A district per customer."""
    return read_table(spark, sf, "orders").select("o_custkey").distinct().select(
        F.format_string("%05d", "o_custkey").alias("area_id"), F.concat(F.lit("D"), F.col("o_custkey").cast("string")).alias("district"))


@register("page_ingest", f"""
WITH r AS (SELECT DISTINCT o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
n AS (SELECT k, year(d) AS y, d, day(d) AS dd, row_number() OVER (PARTITION BY k, year(d) ORDER BY d) AS row_no FROM r),
t AS (SELECT * FROM n, (VALUES (1), (2)) v(try) WHERE try = 1 OR k % 5 = 0 OR k % 7 = 0),
a AS (SELECT k, y, try, row_no, 'D' || k AS district, strftime(d, '%Y-%m-%d') AS year_mon_day,
             CASE WHEN dd % 4 = 0 THEN 'short' ELSE 'ok' END AS status, try = CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS accepted,
             ['东北风', '西风', '南风'][dd % 3 + 1] AS wind, dd || '°' AS max_t, (dd - month(d)) || '°' AS min_t,
             CASE WHEN dd % 4 <> 0 THEN CAST(dd * 10 AS VARCHAR) END AS aqi, CASE WHEN dd % 4 <> 0 THEN '良' END AS aqi_type FROM t
      UNION ALL
      SELECT k, y, 1, max(row_no) + 1, 'D' || k, NULL, 'bad', false, NULL, NULL, NULL, NULL, NULL FROM n WHERE k % 5 = 0 GROUP BY k, y)
SELECT printf('{_FETCHED.replace("%5B", "%%5B").replace("%5D", "%%5D")}', k, y, try) AS url, CAST(row_no AS INTEGER) AS row_no, status, accepted, district,
       year_mon_day, max_t, min_t, wind, aqi, aqi_type FROM a""")
def q_page_ingest(spark, sf):
    path = scratch_path(spark, "pages-fetched")
    _fetched_pages(spark, sf).write.parquet(path)
    areas = _customer_areas(spark, sf)
    nothing = spark.createDataFrame([], ODS)
    rows = ingest.ingest_pages(P.read_pages(spark, path), nothing, areas=areas, marked=True)
    return rows.select("url", "row_no", "status", "accepted", "district", "year_mon_day", "max_t", "min_t", "wind", "aqi", "aqi_type")


_REC_SQL = ("CASE WHEN aqi = '-' THEN concat_ws(',', year_mon_day, week, max_t, min_t, weather, wind, aqi) "
            "ELSE concat_ws(',', year_mon_day, week, max_t, min_t, weather, wind, aqi, '良') END")


def _records(spark, sf):
    o = ods(spark, sf)
    rec = F.when(F.col("aqi") == "-", F.concat_ws(",", "year_mon_day", "week", "max_t", "min_t", "weather", "wind", "aqi")) \
           .otherwise(F.concat_ws(",", "year_mon_day", "week", "max_t", "min_t", "weather", "wind", "aqi", F.lit("良")))
    return o.select(*ROW_ID, rec.alias("record"))


@register("record_route", WITH_OBS + f""",
r AS (SELECT l_orderkey, l_linenumber, string_split({_REC_SQL}, ',') AS p FROM obs)
SELECT l_orderkey, l_linenumber,
       CASE WHEN len(p) = 8 THEN 'ok' WHEN len(p) BETWEEN 6 AND 7 AND p[-1] = '-' AND p[6] <> '' THEN 'short' ELSE 'bad' END AS status,
       p[1] AS year_mon_day, p[2] AS week, p[3] AS max_t, p[4] AS min_t, p[5] AS weather,
       regexp_extract(p[6], '^\\s*([^\\s]+)', 1) AS wind,
       CASE WHEN len(p) = 8 THEN p[7] END AS aqi, CASE WHEN len(p) = 8 THEN p[8] END AS aqi_type
FROM r""")
def q_record_route(spark, sf):
    return ingest.route_records(_records(spark, sf), wind_domain=None).drop("record")


@register("leading_token", WITH_OBS + "\nSELECT l_orderkey, l_linenumber, wind, "
          "regexp_extract(wind, '^\\s*([^\\s]+)', 1) AS wind_token FROM obs")
def q_leading_token(spark, sf):
    return ods(spark, sf).select(*ROW_ID, "wind", leading_token("wind").alias("wind_token"))


_GRID_URL = ("'http://weather.example/history?areaInfo%5BareaId%5D=' || CAST(n_nationkey AS VARCHAR) || "
             "'&areaInfo%5BareaType%5D=2&date%5Byear%5D=' || CAST(y.year AS VARCHAR) || "
             "'&date%5Bmonth%5D=' || CAST(m.month AS VARCHAR)")


@register("target_grid", f"""
SELECT n_nationkey AS area_id, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month, {_GRID_URL} AS url
FROM nation, range(2016, 2025) y(year), range(1, 13) m(month)""")
def q_target_grid(spark, sf):
    areas = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("area_id"))
    return grid.target_grid(areas, "area_id", 2016, 2024)


@register("missing_targets", """
WITH g AS (SELECT n_nationkey AS area_id, CAST(y.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month
           FROM nation, range(1995, 2002) y(year), range(1, 13) m(month)),
s AS (SELECT DISTINCT s_nationkey AS area_id, CAST(year(l_shipdate) AS INTEGER) AS year,
             CAST(month(l_shipdate) AS INTEGER) AS month
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT area_id, year, month FROM g
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.area_id = g.area_id AND s.year = g.year AND s.month = g.month)""")
def q_missing_targets(spark, sf):
    areas = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("area_id"))
    g = grid.target_grid(areas, "area_id", 1995, 2001).drop("url")
    li = read_table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate")
    sup = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    stored = li.join(sup, li.l_suppkey == sup.s_suppkey).select(
        F.col("s_nationkey").alias("area_id"), F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
    return ingest.missing_targets(g, stored, ["area_id", "year", "month"])


@register("url_lookup", """
SELECT p.page_id, p.page_no, n.n_name
FROM (SELECT page_id, TRY_CAST(regexp_extract(url, '[?&]page=([^&#]*)', 1) AS INTEGER) AS page_no FROM pages) p
LEFT JOIN nation n ON p.page_no = n.n_nationkey""")
def q_url_lookup(spark, sf):
    pg = read_table(spark, sf, "pages", spread_on=["page_id"]).select(
        "page_id", url_param("url", "page").try_cast("int").alias("page_no"))
    nat = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    return ingest.lookup(pg, nat, "page_no", "n_nationkey").select("page_id", "page_no", "n_name")


@register("dead_letter", """
WITH e AS (SELECT event_id, user_id, ts, event_type,
                  lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt
           FROM events)
SELECT event_id, user_id, ts, event_type FROM e WHERE event_type = 'error' AND (nxt IS NULL OR nxt = 'error')""")
def q_dead_letter(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return ingest.dead_letter(ev, ["user_id"], ["ts", "event_id"], status="event_type", fail_value="error")


_ORD_INC = """inc AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice,
                   year(o_orderdate) AS yr, month(o_orderdate) AS mo
            FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
tgt AS (SELECT DISTINCT o_custkey, month(o_orderdate) AS mo FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01')"""


def _orders_split(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice") \
        .withColumn("yr", F.year("o_orderdate")).withColumn("mo", F.month("o_orderdate"))
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    return o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)


@register("batch_atomic", f"""
WITH RECURSIVE {_ORD_INC},
b AS (SELECT o_custkey, yr, list(DISTINCT mo) AS months, count(*) <> count(DISTINCT mo) AS twice,
             row_number() OVER (PARTITION BY o_custkey ORDER BY yr) AS turn
      FROM inc GROUP BY o_custkey, yr),
s AS (SELECT c.o_custkey, CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS yr, false AS stored,
             coalesce(t.held, []) AS held
      FROM (SELECT DISTINCT o_custkey FROM b) c
      LEFT JOIN (SELECT o_custkey, list(mo) AS held FROM tgt GROUP BY o_custkey) t ON t.o_custkey = c.o_custkey
      UNION ALL
      SELECT b.o_custkey, b.turn, b.yr, NOT b.twice AND NOT list_has_any(s.held, b.months),
             CASE WHEN b.twice OR list_has_any(s.held, b.months) THEN s.held ELSE list_concat(s.held, b.months) END
      FROM s JOIN b ON b.o_custkey = s.o_custkey AND b.turn = s.turn + 1)
SELECT o_orderkey, inc.o_custkey, o_orderdate, o_totalprice, s.stored AS accepted
FROM inc JOIN s ON s.o_custkey = inc.o_custkey AND s.yr = inc.yr""")
def q_batch_atomic(spark, sf):
    target, incoming = _orders_split(spark, sf)
    m = ingest.mark_batches(target, incoming, batch=["o_custkey", "yr"], key=["o_custkey", "mo"], batch_order=["yr"])
    return m.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "accepted")


@register("first_wins", f"""
WITH {_ORD_INC},
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, mo ORDER BY o_orderdate, o_orderkey) AS rn FROM inc)
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM r
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_custkey = r.o_custkey AND tgt.mo = r.mo)""")
def q_first_wins(spark, sf):
    target, incoming = _orders_split(spark, sf)
    acc, _ = ingest.insert_batches(target, incoming, batch=["o_custkey", "yr"], key=["o_custkey", "mo"],
                                   mode="first_wins", order=["o_orderdate", "o_orderkey"])
    return acc.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@register("tagged_union", """
SELECT 'customer' AS source, c_custkey, c_name, c_nationkey, c_acctbal FROM customer
UNION ALL
SELECT 'supplier' AS source, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def q_tagged_union(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    supp = read_table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    Q.register_views(spark, {"sf_customer": cust, "sf_supplier": supp})
    names = [n for n in ingest.list_tables(spark, prefix="sf_") if n in ("sf_customer", "sf_supplier")]
    u = ingest.union_catalog(spark, names, tag_col="source")
    return u.withColumn("source", F.regexp_replace("source", "^sf_", ""))


@register("dedupe", WITH_DWD + f"""
SELECT {DWD_COLS} FROM dwd
QUALIFY row_number() OVER (PARTITION BY district, year_mon_day ORDER BY {', '.join(ROW_ID + TIE_BREAK)}) = 1""")
def q_dedupe(spark, sf):
    return ingest.dedupe(dwd(spark, sf), ["district", "year_mon_day"], ROW_ID + TIE_BREAK)


@register("dedupe_null_order", WITH_DWD + f""",
n AS (SELECT *, CASE WHEN l_linenumber > 1 THEN l_orderkey END AS seen FROM dwd)
SELECT {DWD_COLS}, seen FROM n
QUALIFY row_number() OVER (PARTITION BY district, year_mon_day
                           ORDER BY seen NULLS LAST, {', '.join(ROW_ID + TIE_BREAK)}) = 1""")
def q_dedupe_null_order(spark, sf):
    # rows without an order value never win over rows that have one
    rows = dwd(spark, sf).withColumn("seen", F.when(F.col("l_linenumber") > 1, F.col("l_orderkey")))
    return ingest.dedupe(rows, ["district", "year_mon_day"], ["seen"] + ROW_ID + TIE_BREAK)


_RULES_SQL = """
  list_filter([
    CASE WHEN NOT coalesce(TRY_CAST(replace(max_t, '°', '') AS INTEGER) IS NOT NULL, false) THEN 'max_t_int' END,
    CASE WHEN NOT coalesce(TRY_CAST(replace(min_t, '°', '') AS INTEGER) IS NOT NULL, false) THEN 'min_t_int' END,
    CASE WHEN NOT coalesce(TRY_CAST(replace(min_t, '°', '') AS INTEGER) <= TRY_CAST(replace(max_t, '°', '') AS INTEGER), false) THEN 'min_le_max' END,
    CASE WHEN NOT coalesce(aqi = '-' OR TRY_CAST(aqi AS DOUBLE) BETWEEN 0 AND 300, false) THEN 'aqi_range' END,
    CASE WHEN NOT coalesce(regexp_matches(year_mon_day, '^\\d{4}-\\d{2}-\\d{2}$'), false) THEN 'date_iso' END
  ], lambda x: x IS NOT NULL)"""


def validity_rules():
    """Rules of the ``split_valid`` query (name -> condition a valid row meets)."""
    tmax = F.replace(F.col("max_t"), F.lit("°"), F.lit("")).try_cast("int")
    tmin = F.replace(F.col("min_t"), F.lit("°"), F.lit("")).try_cast("int")
    aqi = F.col("aqi").try_cast("double")
    return {
        "max_t_int": tmax.isNotNull(),
        "min_t_int": tmin.isNotNull(),
        "min_le_max": tmin <= tmax,
        "aqi_range": (F.col("aqi") == "-") | aqi.between(0, 300),
        "date_iso": F.col("year_mon_day").rlike(r"^\d{4}-\d{2}-\d{2}$"),
    }


@register("split_valid", WITH_OBS + f""",
v AS (SELECT l_orderkey, l_linenumber, {_RULES_SQL} AS vio FROM obs)
SELECT l_orderkey, l_linenumber, len(vio) = 0 AS valid, array_to_string(vio, ',') AS violations FROM v""")
def q_split_valid(spark, sf):
    m = ingest.mark_valid(ods(spark, sf), validity_rules())
    return m.select(*ROW_ID, "valid", F.array_join("violations", ",").alias("violations"))


# ------------------------------------------------------------ sinks, sources

@register("stage_sanitize", r"""
SELECT doc_id, regexp_replace(text, '[\n\r\x01]', '', 'g') AS text, lang, source FROM documents""")
def q_stage_sanitize(spark, sf):
    docs = read_table(spark, sf, "documents", spread_on=["doc_id"]).select("doc_id", "text", "lang", "source")
    path = staged.stage_text(docs, scratch_path(spark, "staged-documents"))
    return staged.read_staged(spark, path, docs.schema)


@register("stage_edges", r"""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '\N' || lang WHEN 2 THEN '\N' ELSE '' END AS mark,
       '  ' || regexp_replace(text, '[\n\r\x01]', '', 'g') || chr(9) AS text FROM documents""")
def q_stage_edges(spark, sf):
    docs = read_table(spark, sf, "documents", spread_on=["doc_id"])
    n = F.col("doc_id") % 4
    mark = F.when(n == 1, F.concat(F.lit("\\N"), "lang")).when(n == 2, F.lit("\\N")).when(n == 3, F.lit(""))
    rows = docs.select("doc_id", mark.alias("mark"), F.concat(F.lit("  "), "text", F.lit("\t")).alias("text"))
    path = staged.stage_text(rows, scratch_path(spark, "staged-documents"))
    return staged.read_staged(spark, path, rows.schema)


@register("append_twice", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def q_append_twice(spark, sf):
    db = tables.ensure_database(spark, "skyframe_scratch", location=scratch_path(spark, "db-scratch"))
    sup = read_table(spark, sf, "supplier").select("s_suppkey", "s_name")
    name = tables.ensure_table(spark, f"{db}.appended_{uuid.uuid4().hex[:8]}", sup.schema, path=scratch_path(spark, "table-appended"))
    for _ in range(2):
        tables.write_table(sup, name, mode="append")
    return tables.read_table(spark, name)


@register("table_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_table_roundtrip(spark, sf):
    db = tables.ensure_database(spark, "skyframe_scratch", location=scratch_path(spark, "db-scratch"))
    name = f"{db}.supplier_{uuid.uuid4().hex[:8]}"
    sup = read_table(spark, sf, "supplier")
    tables.write_table(sup, name, mode="overwrite", path=scratch_path(spark, "table-supplier"))
    return tables.read_table(spark, name)


@register("backup_restore", "SELECT * FROM orders")
def q_backup_restore(spark, sf):
    orders = read_table(spark, sf, "orders")
    snap = snapshot.backup(orders, scratch_path(spark, "backup-orders"))
    return snapshot.restore(spark, snap, verify=True)


@register("stream_ingest", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def q_stream_ingest(spark, sf):
    schema = read_table(spark, sf, "events").schema
    return ingest_stream(spark, f"{sf}/events*.parquet", schema, key=["user_id", "event_type"], order=["ts", "event_id"])


_WAVE = "purchase"


@register("stream_waves", f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type <> '{_WAVE}', ts, event_id) = 1""")
def q_stream_waves(spark, sf):
    # a first wave of one type, then all events: stored keys stay as the first wave left them
    events = read_table(spark, sf, "events")
    landing, target, state = (scratch_path(spark, n) for n in ("landing", "stream-target", "stream-ckpt"))
    for wave in (events.filter(F.col("event_type") == _WAVE), events):
        wave.write.mode("append").parquet(landing)
        out = ingest_stream(spark, landing, events.schema, key=["user_id"], order=["ts", "event_id"], target=target, checkpoint=state)
    return out


# ------------------------------------------------- dashboard views by grain

@register("pie_day", WITH_DWD + f"""
SELECT weather, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM dwd
WHERE district = 'AMERICA' AND year_mon_day = '{DAY}' GROUP BY weather""")
def q_pie_day(spark, sf):
    return dashboard.pie_panel(dwd(spark, sf), "AMERICA区", DAY)["shares"]


@register("parallel_year", WITH_DWD + f"""
SELECT max_t, min_t, weather, wind, aqi, aqi_type, {_CLASS_POS} AS class_no FROM dwd
WHERE district = 'ASIA' AND substr(year_mon_day, 1, 4) = '1998' AND aqi_type IS NOT NULL""")
def q_parallel_year(spark, sf):
    return dashboard.parallel_panel(dwd(spark, sf), "ASIA区", "1998")["series"]


@register("extents_month", WITH_DWD + """
SELECT max(max_t) AS max_t_hi, min(max_t) AS max_t_lo, max(min_t) AS min_t_hi, min(min_t) AS min_t_lo,
       max(aqi) AS aqi_hi, min(aqi) AS aqi_lo FROM dwd
WHERE district = 'AFRICA' AND substr(year_mon_day, 1, 7) = '2000-02'""")
def q_extents_month(spark, sf):
    return dashboard.parallel_panel(dwd(spark, sf), "AFRICA区", "2000-02")["extents"]


@register("bar_month", WITH_DWD + """
SELECT weather, round_even(avg(aqi), 2) AS avg_aqi FROM dwd
WHERE district = 'MIDDLE EAST' AND substr(year_mon_day, 1, 7) = '1999-07' GROUP BY weather""")
def q_bar_month(spark, sf):
    return dashboard.bar_panel(dwd(spark, sf), "MIDDLE EAST区", "1999-07")


@register("map_month", WITH_DWD + f""",
m AS ({_MAP_SQL} WHERE substr(year_mon_day, 1, 7) = '1996-02')
SELECT *, {PIECES_SQL} AS piece, CAST(dense_rank() OVER (ORDER BY year_mon_day) AS INTEGER) AS frame FROM m""")
def q_map_month(spark, sf):
    return dashboard.map_panel(dwd(spark, sf), "1996-02")


_ORDER_LABELS = ["空气质量", "天气", "空气质量指数", "最低温"]


@register("select_label_order", WITH_DWD + f"\nSELECT {_labels_sql(_ORDER_LABELS)} FROM dwd "
          "WHERE district = 'AFRICA' AND substr(year_mon_day, 1, 4) = '2001'")
def q_select_label_order(spark, sf):
    return dashboard.data_table(dwd(spark, sf), "AFRICA区", "2001", _ORDER_LABELS)


from . import stores  # noqa: E402, F401  (registers its queries; needs what is above)
