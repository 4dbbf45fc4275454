"""Serving tables: the staged (ODS) and cleaned (DWD) tables, each written
once per application and read by every later query (land -> ODS -> clean ->
DWD -> dashboard).

The cleaned table is written under the shared checkpoint folder, partitioned
by district (a place filter prunes whole folders) and range-partitioned and
sorted by (district, date) before the write, so each task writes a
contiguous slice, a large district is split over many tasks, and the
Parquet row-group statistics on the date let a period prefix skip data.
The staged table, which jobs read whole, is written as its joins leave it.

Adaptive execution joins range partitions by their compressed bytes, and
these texts compress so well that a task would sort more rows than it has
memory for and spill them.  So ``deal`` cuts a large table by rows.

Within one Spark application the inputs are taken as immutable; pass
``refresh=True`` to rebuild after they change.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Rows that one task sorts, where their number is known.
TASK_ROWS = 250_000

_SERVED: dict[tuple[str, str], tuple[str, DataFrame]] = {}
_LOCK = threading.RLock()  # builds nest (DWD build reads the ODS table)


def deal(df: DataFrame, keys, rows: int = 0) -> DataFrame:
    """``df`` range-partitioned by ``keys``: as adaptive execution sees fit, or,
    known to have ``rows``, into tasks of about ``TASK_ROWS``."""
    n = -(-rows // TASK_ROWS)
    return df.repartitionByRange(n, *keys) if n > 1 else df.repartitionByRange(*keys)


def serving_table(spark: SparkSession, key: str, build: Callable[[], DataFrame],
                  partition_by=("district",), sort_by=("year_mon_day",), spread_by=(), dealt: bool = False, refresh: bool = False) -> DataFrame:
    """The table ``key`` of this application: built by ``build`` and written
    on first use (or when ``refresh``), then read back from storage.

    ``spread_by`` columns (a row id) come last in the range key, so that the
    rows of one hot (partition, sort) value are split over tasks.  ``dealt``
    says that ``build`` has range-partitioned its rows so; without ``partition_by``
    and ``sort_by`` columns rows are written as they come."""
    k = (spark.sparkContext.applicationId, key)
    with _LOCK:
        hit = _SERVED.get(k)
        if hit is None or refresh:
            df = build()
            path = scratch_path(spark, "serving")
            keys = [*partition_by, *sort_by]
            if keys:
                df = (df if dealt else deal(df, [*keys, *spread_by])).sortWithinPartitions(*keys)
            df.write.mode("error").partitionBy(*partition_by).parquet(path)
            # declared schema: partition values are not type-inferred; the
            # frame (and its file listing) is kept for later queries
            table = spark.read.schema(df.schema).parquet(path).select(*df.columns)
            hit = (path, table)
            _SERVED[k] = hit
    return hit[1]
