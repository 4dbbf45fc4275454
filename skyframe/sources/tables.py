"""Catalog tables: create-if-absent, table scans, managed/external sinks
(overwrite, append), partitioned by district where asked so that a place
filter prunes whole directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def quote_ident(name: str) -> str:
    """Back-quote each part of a (possibly qualified, non-ASCII) name."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> str:
    """CREATE DATABASE IF NOT EXISTS."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(db)}{loc}")
    return db


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 partition_by=(), path: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS with a declared schema."""
    if not spark.catalog.tableExists(name):
        w = spark.createDataFrame([], schema).write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    return name


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by=(), path: str | None = None, sort_within=(), bucket_by=None) -> str:
    """Save as a catalog table.  ``mode`` is the real save mode
    ('overwrite' default, 'append', 'error', 'ignore').  With
    ``partition_by`` + ``sort_within`` the data is range-partitioned on
    (partition columns, sort columns) first: each task writes a contiguous
    slice (few files), and a large partition value is split across tasks
    rather than hashed into one.

    ``bucket_by=(n, columns)`` writes a bucketed table instead (hash of the
    columns into n buckets, sorted by them; one file per bucket and task
    after a repartition into the n buckets): later joins and semi joins on
    exactly those columns read it without a shuffle of its side."""
    out = df
    if bucket_by:
        n, bcols = bucket_by[0], list(bucket_by[1])
        out = out.repartition(n, *bcols)
    elif partition_by and sort_within:
        out = out.repartitionByRange(*partition_by, *sort_within)
    if sort_within and not bucket_by:
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(n, *bcols).sortBy(*bcols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan (lazy)."""
    return spark.table(name)
