"""Chart data: the frames behind the trend lines, the per-day district map
and its timeline, category counts and shares, class-split series, axis
extents and grouped means.  Only data is built; drawing is the caller's.

All aggregations are hash aggregates with a map-side partial step, so a hot
category is pre-combined before any shuffle.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.scalars import domain_ordinal, mean_temp, period_grain, pieces
from .joins import materialize_sized
from .query import scope
from .ranking import carry_forward

GRAIN_LEN = {"year": 4, "month": 7, "day": 10}


def trend(df: DataFrame, place: str, period: str = "") -> DataFrame:
    """A1: (date, high, low, mean) of one place over a period; a single day
    has no trend, so the day grain gives an empty frame."""
    rows = scope(df, place, period)
    if period_grain(period) == "day":
        rows = rows.filter(F.lit(False))
    return (rows.select("year_mon_day", "max_t", "min_t", mean_temp().alias("mean_t"))
            .orderBy("year_mon_day"))


def avg_temp(df: DataFrame, keys=("district",)) -> DataFrame:
    """A2: mean of the row mean temperature per key."""
    return df.groupBy(*keys).agg(F.avg(mean_temp()).alias("avg_t"))


def timeline(df: DataFrame, period: str = "", col: str = "year_mon_day") -> DataFrame:
    """A3: distinct time values of a period, in time order."""
    return scope(df, None, period).select(col).distinct().orderBy(col)


def map_frame(df: DataFrame, period: str = "") -> DataFrame:
    """A4: per row of the period, (time, district label, mean temperature)."""
    return scope(df, None, period).select(
        "year_mon_day",
        F.concat(F.col("district"), F.lit(fixed.PLACE_SUFFIX)).alias("area"),
        mean_temp().alias("mean_t"))


def map_piece(df: DataFrame, period: str = "", spec=fixed.MAP_PIECES) -> DataFrame:
    """A4+A5: map frame with the value piece of each point (NULL in gaps)."""
    f = map_frame(df, period)
    return f.withColumn("piece", pieces("mean_t", spec))


def map_timeline(df: DataFrame, period: str = "", spec=fixed.MAP_PIECES) -> DataFrame:
    """All map frames keyed by time, in long form: each point carries the
    1-based frame number of its time value.  Frames are not collected into
    arrays (a frame grows with the rows of its day); the frame numbers come
    from the distinct time values, whose count is bounded by the calendar,
    ranked once and broadcast after a size check."""
    f = map_piece(df, period, spec)
    times = f.select("year_mon_day").distinct()
    numbered = times.withColumn(
        "frame", F.row_number().over(Window.orderBy("year_mon_day")).cast("int"))
    numbered = materialize_sized(numbered)
    return f.join(numbered, "year_mon_day")


def _counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _by_count(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.col("n").desc(), F.col(col).asc_nulls_last())


def category_counts(df: DataFrame, col: str = "weather") -> DataFrame:
    """Rows per category; NULL is its own category.  Ordered by count
    (descending), then value — a sort of the aggregated categories only."""
    return _by_count(_counts(df, col), col)


def category_share(df: DataFrame, col: str = "weather") -> DataFrame:
    """Count and share of all rows per category.  The total is a window
    over the aggregated categories (one row each), not over the rows."""
    c = _counts(df, col).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return _by_count(c, col)


def extents(df: DataFrame, cols=("max_t", "min_t", "aqi")) -> DataFrame:
    """Max and min of each column (NULLs ignored; NULL when empty)."""
    aggs = []
    for c in cols:
        aggs += [F.max(c).alias(f"{c}_hi"), F.min(c).alias(f"{c}_lo")]
    return df.agg(*aggs)


def distinct_values(df: DataFrame, col: str = "weather") -> DataFrame:
    """A10: the distinct values of a column."""
    return df.select(col).distinct()


def class_series(df: DataFrame, col: str = "aqi_type", domain=fixed.AQI_CLASSES) -> DataFrame:
    """Rows split over the fixed class domain (class_no = position);
    rows of no class are dropped."""
    return (df.withColumn("class_no", domain_ordinal(col, domain))
              .filter(F.col("class_no").isNotNull()))


def class_pivot(df: DataFrame, col: str = "aqi_type", domain=fixed.AQI_CLASSES) -> DataFrame:
    """A11, wide: one row with the row count of each class (0 when none), by
    one aggregation."""
    return df.agg(*[F.count_if(F.col(col) == F.lit(c)).alias(c) for c in domain])


def category_mean(df: DataFrame, key: str = "weather", val: str = "aqi", digits: int = 2,
                  out: str = "avg_aqi") -> DataFrame:
    """Mean of ``val`` per category, rounded half-to-even."""
    return df.groupBy(key).agg(F.bround(F.avg(val), digits).alias(out))


def rollup_period(df: DataFrame, grain: str = "month", keys=("district",)) -> DataFrame:
    """Per key and year / month / day: mean, min and max temperatures,
    mean AQI and the row count."""
    n = GRAIN_LEN[grain]
    return (df.groupBy(*keys, F.substring("year_mon_day", 1, n).alias("period"))
              .agg(F.avg("max_t").alias("avg_max_t"),
                   F.avg("min_t").alias("avg_min_t"),
                   F.max("max_t").alias("max_max_t"),
                   F.min("min_t").alias("min_min_t"),
                   F.avg("aqi").alias("avg_aqi"),
                   F.count(F.lit(1)).alias("n")))


def timeline_filled(df: DataFrame, keys, day: str = "year_mon_day", values=(), low: str | None = None, high: str | None = None) -> DataFrame:
    """A3/A6 without gaps: a row per key and calendar day from ``low`` to ``high`` (ISO days; those of the
    rows by default), with the values of the latest row on or before the day and its date as
    ``filled_from``; NULL before a key's first row.

    ``df`` has at most one row per key and day; rows outside of the span count only as earlier values.  The
    days come from a generator per key, and values are carried along the ordered days, over
    the borders of tasks too, without a window per key."""
    keys, values = list(keys), list(values)
    span = df.agg(F.coalesce(F.lit(low), F.min(day)).alias("a"), F.coalesce(F.lit(high), F.max(day)).alias("b")).first()
    rows = df.select(*keys, F.col(day).alias("_day"), F.struct(*values, F.col(day).alias("filled_from")).alias("_seen")).filter(F.col("_day").isNotNull())
    if span["a"] is None or span["b"] is None:
        days = df.select(*keys, F.lit("").alias("_day")).limit(0)
    else:
        every = F.sequence(F.lit(span["a"]).cast("date"), F.lit(span["b"]).cast("date"))
        days = df.select(*keys).distinct().withColumn("_day", F.explode(every)).withColumn("_day", F.date_format("_day", "yyyy-MM-dd"))
    both = rows.withColumn("_wanted", F.lit(0)).unionByName(days.withColumn("_seen", F.lit(None).cast(rows.schema["_seen"].dataType)).withColumn("_wanted", F.lit(1)))
    filled = carry_forward(both, keys, ["_day", "_wanted"], "_seen")
    return filled.filter("_wanted = 1").select(*keys, F.col("_day").alias(day), *[F.col(f"_seen.{v}").alias(v) for v in values], F.col("_seen.filled_from").alias("filled_from"))


def day_partials(df: DataFrame, keys=("district",)) -> DataFrame:
    """Mergeable partials per key and day: counts, sums, least and greatest values."""
    sums = [a for c in ("max_t", "min_t", "aqi") for a in (F.sum(c).cast("double").alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]
    return df.groupBy(*keys, "year_mon_day").agg(F.count(F.lit(1)).alias("n"), F.max("max_t").alias("max_max_t"), F.min("min_t").alias("min_min_t"), *sums)


def rollup_levels(df: DataFrame, keys=("district",)) -> DataFrame:
    """D8 in one pass: day, month, year and all-time rollups together (``grain``, ``period``; '' for all time).

    The rows are scanned and aggregated once, to day partials; the levels are grouping sets over these."""
    keys = list(keys)
    days = day_partials(df, keys).withColumns({"_y": F.substring("year_mon_day", 1, 4), "_m": F.substring("year_mon_day", 1, 7)})
    sets = [[*keys, "_y", "_m", "year_mon_day"], [*keys, "_y", "_m"], [*keys, "_y"], keys]
    mean = lambda c: (F.sum(f"{c}_sum") / F.nullif(F.sum(f"{c}_n"), F.lit(0))).alias(f"avg_{c}")
    at = days.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in sets[0]]).agg(
        F.grouping("_y").alias("_gy"), F.grouping("_m").alias("_gm"), F.grouping("year_mon_day").alias("_gd"), F.sum("n").alias("n"), mean("max_t"),
        F.max("max_max_t").alias("max_max_t"), F.min("min_min_t").alias("min_min_t"), mean("aqi"))
    pick = lambda d, m, y, rest: F.when(F.col("_gd") == 0, d).when(F.col("_gm") == 0, m).when(F.col("_gy") == 0, y).otherwise(rest)
    return at.select(*keys, pick(F.lit("day"), F.lit("month"), F.lit("year"), F.lit("all")).alias("grain"), pick(F.col("year_mon_day"), F.col("_m"), F.col("_y"), F.lit("")).alias("period"),
                     "n", "avg_max_t", "max_max_t", "min_min_t", "avg_aqi")
