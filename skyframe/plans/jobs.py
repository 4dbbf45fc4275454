"""The batch jobs of the weather history, as a user runs them:

* ``collect_job`` — landed pages -> records -> rows accepted batch-atomically
  into the observation table (append), rejected rows returned.
* ``merge_job`` — tagged union of per-district tables into one table.
* ``stage_job`` — any source frame (e.g. ``read_jdbc``) -> sanitised
  delimited text, full refresh, with an ODS table over it.
* ``load_clean_job`` — staged ODS table -> cleaned DWD table, partitioned by
  district and range-sorted by date.

Each job is one lazy plan per write; the only driver actions are the
writes (and the bounded size checks inside the operators).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean
from ..operators.ingest import ingest_pages, union_catalog
from ..operators.joins import materialize
from ..schema import ODS
from ..sources.staged import NULL, SEP, stage_text
from ..sources.tables import quote_ident, write_table


def _table_or_empty(spark: SparkSession, name: str, schema) -> DataFrame:
    if spark.catalog.tableExists(name):
        return spark.table(quote_ident(name))
    return spark.createDataFrame([], schema)


def collect_job(spark: SparkSession, pages: DataFrame, target: str, mode: str = "atomic",
                path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Append the rows of ``pages`` accepted against what ``target`` already
    holds; returns the rejected rows (checkpointed, so they stay those of
    this run).  With ``buckets`` the store is bucketed by its key
    (district, date) instead of partitioned by district, so a check of a
    bulk load too large to broadcast does not shuffle the store."""
    stored = _table_or_empty(spark, target, ODS)
    # both sides are decided against the target as it is now: checkpoint
    # them before the append changes it (atomic: one marked pass)
    if mode == "atomic":
        m = materialize(ingest_pages(pages, stored, mode=mode, marked=True))
        landed = m.filter("accepted").select(*ODS.fieldNames())
        rejected = m.filter("NOT accepted").drop("accepted")
    else:
        accepted, rejected = ingest_pages(pages, stored, mode=mode)
        landed, rejected = materialize(accepted), materialize(rejected)
    if buckets:
        write_table(landed, target, mode="append", path=path,
                    bucket_by=(buckets, ["district", "year_mon_day"]))
    else:
        write_table(landed, target, mode="append", partition_by=("district",), sort_within=("year_mon_day",),
                    path=path)
    return rejected


def merge_job(spark: SparkSession, tables: list[str], target: str, tag_col: str = "地区",
              mode: str = "overwrite", path: str | None = None) -> str:
    """Tagged union of the named tables into ``target``."""
    merged = union_catalog(spark, tables, tag_col=tag_col)
    return write_table(merged, target, mode=mode, path=path)


def load_clean_job(spark: SparkSession, ods_table: str, dwd_table: str, keep=(), path: str | None = None) -> str:
    """ODS table -> cleaned DWD table (overwrite)."""
    dwd = clean(spark.table(quote_ident(ods_table)), keep=keep)
    return write_table(dwd, dwd_table, mode="overwrite", partition_by=("district",),
                       sort_within=("year_mon_day",), path=path)


def stage_job(spark: SparkSession, source: DataFrame, path: str, table: str,
              sep: str = SEP, null: str = NULL) -> str:
    """Full-refresh staging: the source rows (ODS columns, cast to text) are
    written as sanitised delimited text at ``path`` (overwrite).  An external
    text table with the ODS schema, ``<table>_text``, is (re)created over it,
    and ``table`` as a view of it that takes off the mark before values that
    begin like the null marker, so that what was staged is what is read."""
    from pyspark.sql import functions as F

    rows = source.select(*[F.col(f.name).cast("string").alias(f.name) for f in ODS.fields])
    stage_text(rows, path, sep=sep, null=null, mode="overwrite")
    text, view = f"{table}_text", quote_ident(table)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")
    spark.sql(f"DROP TABLE IF EXISTS {quote_ident(text)}")
    spark.catalog.createTable(text, path=path, source="csv", schema=ODS,
                              sep=sep, nullValue=null, quote='"', escape='"', header="false")
    mark = (null + null).replace("\\", "\\\\").replace("'", "\\'")
    undone = [f"CASE WHEN startswith({c}, '{mark}') THEN substring({c}, {len(null) + 1}) ELSE {c} END AS {c}" if null else c
              for c in map(quote_ident, ODS.fieldNames())]
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {', '.join(undone)} FROM {quote_ident(text)}")
    return table
