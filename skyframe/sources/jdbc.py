"""JDBC source and sink through Spark's JDBC data source.

Reads are parallel when a numeric/date partition column and bounds are
given (``numPartitions`` range queries); otherwise one query, like a
single-mapper import.  The sink uses the real save mode.  Credentials and
driver class come from the caller's ``properties``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000,
              properties: dict | None = None) -> DataFrame:
    """Read a query or a table; partitioned when a partition column, bounds
    and a partition count are given."""
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        if partition_column:
            # partitioned reads need a table expression, not the query option
            r = r.option("dbtable", f"({query}) q")
        else:
            r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
              .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "error", batch_size: int = 1000,
               num_partitions: int | None = None, properties: dict | None = None) -> None:
    """Write with a real save mode; ``num_partitions`` caps concurrent
    connections (coalesce, no shuffle)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
            .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
