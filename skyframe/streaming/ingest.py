"""Incremental ingest of newly landed files with Structured Streaming.

A file-source stream runs (``availableNow``: everything landed so far,
then stop — a scheduled run replaces the periodic crawl).  Each micro-batch
keeps the first row per key (an aggregate, combined map-side), drops keys
already stored by *earlier* batches and appends its rows to a keyed store
(``sources.keyed``): the check opens only stored files whose key range and Bloom
filter allow a key of the micro-batch.  A replayed batch rewrites its own
folders and sees the same earlier state: the sink is idempotent and the key
stays unique across batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import materialize
from ..operators.ranking import first_per_key
from ..session import scratch_path
from ..sources import keyed
from ..sources.versions import exists


def _stored(spark: SparkSession, target: str) -> DataFrame | None:
    """What is stored under ``target``; None where nothing is yet."""
    return spark.read.parquet(target) if exists(spark, target) else None


def make_upsert(target: str, key, order):
    """foreachBatch body: first row per key, minus keys stored by earlier
    batches, written to the batch's own folder."""
    key, order = list(key), list(order)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # read by the check of stored keys and by the write: computed once
        firsts = materialize(first_per_key(batch.dropna(subset=key), key, order))
        earlier = keyed.lookup(firsts, target, batch.schema, key, before=batch_id).select(*key)
        keyed.append(firsts.join(earlier, key, "left_anti"), target, batch_id, key)

    return upsert


def ingest_stream(spark: SparkSession, source: str, schema: T.StructType, key, order,
                  target: str | None = None, checkpoint: str | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, timeout_s: float | None = None) -> DataFrame:
    """Run the stream to completion over what has landed; returns the stored
    table (key-unique).  ``target`` / ``checkpoint`` default to fresh folders
    under the session's shared checkpoint folder."""
    target = target or scratch_path(spark, "stream-target")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.load(source).writeStream
         .foreachBatch(make_upsert(target, key, order))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise q.exception()
    stored = keyed.stored(spark, target, schema)
    return spark.createDataFrame([], schema) if stored is None else stored


def make_page_upsert(target: str, rejected: str, mode: str = "atomic", areas: DataFrame | None = None):
    """foreachBatch body for landed pages: extract, route and accept rows
    against what earlier batches stored (S3 -> S4 -> S6/S7)."""
    from ..operators.ingest import ingest_pages
    from ..schema import ODS, ODS_KEY

    def upsert(batch: DataFrame, batch_id: int) -> None:
        def earlier(keys: DataFrame) -> DataFrame:
            return keyed.lookup(keys, target, ODS, ODS_KEY, before=batch_id).select(*ODS_KEY)

        # decide both sides before writing either (they read the same state)
        if mode == "atomic":
            m = materialize(ingest_pages(batch, earlier, areas=areas, mode=mode, marked=True))
            acc = m.filter("accepted").select(*ODS.fieldNames())
            rej = m.filter("NOT accepted").drop("accepted")
        else:
            acc, rej = ingest_pages(batch, earlier, areas=areas, mode=mode)
            acc, rej = materialize(acc), materialize(rej)
        keyed.append(acc, target, batch_id, ODS_KEY)
        rej.write.mode("overwrite").parquet(f"{rejected}/batch_id={batch_id}")

    return upsert


def ingest_pages_stream(spark: SparkSession, source: str, target: str | None = None,
                        rejected: str | None = None, checkpoint: str | None = None, fmt: str = "parquet",
                        mode: str = "atomic", timeout_s: float | None = None, areas: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """D6 for weather pages: run the stream over the pages landed so far;
    returns (stored ODS rows, rejected rows).  ``areas`` (area_id, district)
    replaces the fixed area dimension."""
    from ..schema import ODS, PAGES

    target = target or scratch_path(spark, "pages-target")
    rejected = rejected or scratch_path(spark, "pages-rejected")
    checkpoint = checkpoint or scratch_path(spark, "pages-ckpt")
    q = (spark.readStream.schema(PAGES).format(fmt).load(source).writeStream
         .foreachBatch(make_page_upsert(target, rejected, mode, areas))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception() is not None:
        raise q.exception()
    stored = keyed.stored(spark, target, ODS)
    rej = _stored(spark, rejected)
    return (stored if stored is not None else spark.createDataFrame([], ODS),
            rej.drop("batch_id") if rej is not None else None)
