"""Dashboard panels over the cleaned table: what each view of the
dashboard shows for a place and a period ('' / YYYY / YYYY-MM /
YYYY-MM-DD).  Each panel returns DataFrames (never collected here); the
caller draws them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import fixed
from ..functions.scalars import period_grain
from ..operators import charts
from ..operators import query as Q


def data_table(dwd: DataFrame, place: str, period: str, labels) -> DataFrame:
    """The data query: chosen fields of a place over a period, headed by
    their display labels."""
    return Q.select_fields(dwd, place, period, labels)


def trend_panel(dwd: DataFrame, place: str, period: str) -> DataFrame:
    """Line chart: high, low and mean temperature (empty for a single day)."""
    return charts.trend(dwd, place, period)


def map_panel(dwd: DataFrame, period: str) -> DataFrame:
    """District map: one frame per day of the period (long form, with the
    value piece of each district); a single day gives one frame."""
    return charts.map_timeline(dwd, period)


def pie_panel(dwd: DataFrame, place: str, period: str) -> dict[str, DataFrame]:
    """Weather shares of a place over a period; for a single day also the
    day's weather."""
    out = {"shares": charts.category_share(Q.scope(dwd, place, period), "weather")}
    if period_grain(period) == "day":
        out["day"] = Q.day_weather(dwd, place, period)
    return out


def parallel_panel(dwd: DataFrame, place: str, period: str) -> dict[str, object]:
    """Parallel axes: rows split by air-quality class, axis extents, the
    weather axis (distinct values) and the fixed wind and class axes."""
    rows = Q.scope(dwd, place, period).select("max_t", "min_t", "weather", "wind", "aqi", "aqi_type")
    return {
        "series": charts.class_series(rows),
        "extents": charts.extents(rows),
        "weather_axis": charts.distinct_values(rows, "weather"),
        "wind_axis": list(fixed.WIND_AXIS),
        "class_axis": list(fixed.AQI_CLASSES),
    }


def bar_panel(dwd: DataFrame, place: str, period: str) -> DataFrame:
    """Bar chart: mean AQI per weather, rounded to 2 places."""
    return charts.category_mean(Q.scope(dwd, place, period), "weather", "aqi", 2)
