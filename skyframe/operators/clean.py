"""ODS -> DWD cleaning: unit strip and casts, group-mean gap filling,
air-quality banding, ordering, typed projection.

Everything is a column expression except the gap filling, which is an
aggregate joined back.  The aggregate's keys are (district, calendar day),
the number of districts x 366, so it is landed as a small table, which Spark
broadcasts by its bytes: the big side is read twice but not shuffled.  Beyond
Spark's threshold the join is a shuffle join, which AQE splits when one key
is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import band, lenient_double, month_day, strict_int
from ..schema import DWD
from .joins import materialize_sized


def cast_temperatures(df: DataFrame, cols=("max_t", "min_t"), on_null: str = "fail") -> DataFrame:
    """Unit strip + strict int on each temperature column."""
    return df.withColumns({c: strict_int(c, on_null=on_null, name=c) for c in cols})


def cast_aqi(df: DataFrame, col: str = "aqi") -> DataFrame:
    """Lenient double ('-', '' and NaN become NULL)."""
    return df.withColumn(col, lenient_double(col))


def _with_keys(df: DataFrame, keys: dict[str, Column] | None) -> tuple[DataFrame, list[str], list[str]]:
    """``df`` with the key columns it lacks; the names of all keys, and of those added."""
    if keys is None:
        keys = {"district": F.col("district"), "_md": month_day("year_mon_day")}
    added = {k: e for k, e in keys.items() if k not in df.columns}
    return df.withColumns(added) if added else df, list(keys), list(added)


def group_means(df: DataFrame, col: str = "aqi", keys: dict[str, Column] | None = None) -> DataFrame:
    """The mean of the non-null values of each group, landed."""
    keyed, names, _ = _with_keys(df, keys)
    return materialize_sized(keyed.groupBy(*names).agg(F.avg(col).alias("_group_mean")))


def impute_group_mean(df: DataFrame, col: str = "aqi", keys: dict[str, Column] | None = None,
                      digits: int = 0, means: DataFrame | None = None) -> DataFrame:
    """C3+C4: NULL := mean of the non-null values of its group, then the whole
    column is rounded half-to-even to ``digits``.  A group without any value
    stays NULL.  Rows whose key is NULL keep their own (rounded) value.

    ``keys`` maps key names to expressions; default (district, 'MM-DD').
    ``means`` gives the ``group_means`` of the same rows, where they are known.
    """
    keyed, names, added = _with_keys(df, keys)
    if means is None:
        means = group_means(df, col, keys)
    joined = keyed.join(means, on=names, how="left")
    out = joined.withColumn(col, F.bround(F.coalesce(F.col(col), F.col("_group_mean")), digits))
    return out.drop("_group_mean", *added)


def classify_aqi(df: DataFrame, col: str = "aqi", out: str = "aqi_type") -> DataFrame:
    """Band every row (overwrites any source class)."""
    return df.withColumn(out, band(col))


def sort_obs(df: DataFrame, keys=("district", "year_mon_day")) -> DataFrame:
    """Ascending, NULLs last, code-point order (range-partitioned sort)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def to_dwd(df: DataFrame, keep=()) -> DataFrame:
    """Project onto the DWD schema (plus ``keep`` pass-through columns)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DWD.fields]
    return df.select(*cols, *keep)


def clean(ods: DataFrame, keep=(), sort: bool = False, on_null: str = "fail",
          deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The composed ODS -> DWD job (row-wise expressions and the join of
    the group means).

    ``deal`` partitions the staged rows anew before they are cleaned, not
    after: a range exchange reads its input twice."""
    means = group_means(cast_aqi(ods))
    df = cast_temperatures(deal(ods) if deal else ods, on_null=on_null)
    df = cast_aqi(df)
    df = impute_group_mean(df, means=means)
    df = classify_aqi(df)
    df = to_dwd(df, keep=keep)
    return sort_obs(df) if sort else df
