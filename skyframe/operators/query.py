"""Dashboard selections over the cleaned table: district and period
filters, dynamic projection with display labels, day lookups, multi-place
and date-range selections, SQL views.

Parameters become literals inside Column expressions (no SQL text is built
from input).  The period predicate is a prefix test that reaches the
Parquet reader as ``StringStartsWith``; the district equality becomes a
partition filter when the table is stored partitioned by district.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalars import check_period, period_grain, period_predicate, place_name


def columns_for(labels) -> list[tuple[str, str]]:
    """Q1: display labels -> (column, label), order of choice kept."""
    labels = list(labels or [])
    if not labels:
        raise ValueError("choose at least one field")
    out = []
    for lab in labels:
        if lab not in fixed.LABEL_COLUMNS:
            raise ValueError(f"unknown field {lab!r}; choose from {list(fixed.LABEL_COLUMNS)}")
        out.append((fixed.LABEL_COLUMNS[lab], lab))
    return out


def project(df: DataFrame, labels, display: bool = True) -> DataFrame:
    """Q1/Q4: select the chosen fields, headed by their display labels."""
    return df.select(*[F.col(c).alias(lab if display else c) for c, lab in columns_for(labels)])


def check_place(place: str | None, places=fixed.PLACES) -> str | None:
    """Q2: a place that is offered ('朝阳区', or '朝阳' without its suffix)."""
    if place is not None and place not in places and place + fixed.PLACE_SUFFIX not in places:
        raise ValueError(f"unknown place {place!r}; choose from {list(places)}")
    return place


def in_district(df: DataFrame, place: str | None, col: str = "district") -> DataFrame:
    """Q2: rows of one place ('朝阳区' or '朝阳'); None keeps all."""
    if place is None:
        return df
    return df.filter(F.col(col) == F.lit(place_name(place)))


def in_period(df: DataFrame, period: str | None, col: str = "year_mon_day") -> DataFrame:
    """Q3: '' all rows, 'YYYY' a year, 'YYYY-MM' a month, 'YYYY-MM-DD' a day."""
    p = check_period(period)
    return df.filter(period_predicate(p, col)) if p else df


def scope(df: DataFrame, place: str | None = None, period: str | None = "") -> DataFrame:
    """Rows of a place (None: all places) within a period."""
    return in_period(in_district(df, place), period)


def select_fields(df: DataFrame, place: str, period: str, labels) -> DataFrame:
    """The data-table query: place + period + chosen fields."""
    return project(scope(df, place, period), labels)


def day_weather(df: DataFrame, place: str, day: str) -> DataFrame:
    """Q7: the weather of one place on one day."""
    if period_grain(day) != "day":
        raise ValueError("day_weather needs YYYY-MM-DD")
    return scope(df, place, day).select("district", "year_mon_day", "weather")


def day_slice(df: DataFrame, place: str, day: str) -> DataFrame:
    """Q8: (district, max_t, min_t, aqi) of one place on one day."""
    if period_grain(day) != "day":
        raise ValueError("day_slice needs YYYY-MM-DD")
    return scope(df, place, day).select("district", "max_t", "min_t", "aqi")


def in_districts(df: DataFrame, places, col: str = "district") -> DataFrame:
    """D3: several places at once."""
    names = [place_name(p) for p in places]
    return df.filter(F.col(col).isin(names))


def between_days(df: DataFrame, first: str, last: str, col: str = "year_mon_day") -> DataFrame:
    """D3: inclusive ISO date range on the date text."""
    for d in (first, last):
        if period_grain(d) != "day":
            raise ValueError("between_days needs YYYY-MM-DD bounds")
    return df.filter(F.col(col).between(F.lit(first), F.lit(last)))


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Expose frames to ``spark.sql`` as temporary views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
