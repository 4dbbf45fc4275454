"""A store of rows by key that answers "is this key stored" from few files.

Every append writes its rows by bucket of the key (a hash, so buckets are even
whatever the keys are), one file per bucket, sorted by key, and beside them a
summary of each file: row count, least and greatest key, and a Bloom filter of
its keys.

    base/batch_id=<n>/bucket=<b>/part-....parquet      rows
    base/_summary/files/batch_id=<n>/...               file, bucket, rows, lo, hi, blocks
    base/_summary/bloom/batch_id=<n>/...               file, block, bits

A check joins the keys asked for with the summaries, by bucket, and opens only
the files whose range and filter allow one of the keys.  Summaries are some
bytes per key and a few columns per file; filters are blocks of 4 KB, made and
tested by Spark's own bitmap and hash functions.

A batch is written to its own folders with overwrite, and a check sees earlier
batches only: a replayed batch gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import materialize_sized
from .versions import exists

BUCKETS = 16
#: Bits of a Bloom block (fixed by Spark's bitmap functions), keys that share one, and bits set per key.
BLOCK_BITS, BLOCK_KEYS, PROBES = 32_768, 3_000, 4


def _hash(key: list[str], salt: int) -> Column:
    """64-bit hash of a key; NULL parts are told from values."""
    return F.xxhash64(F.lit(salt), *[c for k in key for c in (F.col(k).isNull(), F.col(k))])


def _probe(mark: Column, i: int) -> Column:
    """The ``i``-th bit, from 0, in its block of a key whose hash is ``mark``."""
    return F.shiftrightunsigned(mark, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1))


def _number(file: str = "file") -> Column:
    """A file's short name in rows that are there once per key.  Files that shared one would be
    marked, tested and opened together."""
    return F.xxhash64(file).alias("no")


def _bit(bits: Column, place: Column) -> Column:
    """Is the bit set?"""
    byte = F.conv(F.hex(bits.substr((F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), F.pmod(place, F.lit(8))).cast("int")) > 0


def _read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """What is stored under a path; None where nothing is yet."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path) if exists(spark, path) else None


def append(df: DataFrame, base: str, batch_id: int, key, buckets: int = BUCKETS) -> None:
    """Write the rows of a batch, replacing what a failed try of the same batch left.

    ``buckets`` must be the same for all batches of a store.  Rows of a key are not compared with stored
    ones here; ask ``lookup`` first."""
    key = list(key)
    spark = df.sparkSession
    folder = f"{base}/batch_id={batch_id}"
    bucket = F.pmod(_hash(key, 1), F.lit(buckets)).cast("int")
    laid = df.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", *key)
    laid.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    shape = T.StructType([*df.schema.fields, T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(shape).parquet(folder).select(*key, "bucket", F.col("_metadata.file_path").alias("file"))
    whole = F.struct(*key)
    files = rows.groupBy("file", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min(whole).alias("lo"), F.max(whole).alias("hi"))
    files = files.withColumn("blocks", F.ceil(F.col("n") / BLOCK_KEYS).cast("int"))
    files.write.mode("overwrite").parquet(f"{base}/_summary/files/batch_id={batch_id}")
    sizes = spark.read.schema(files.schema).parquet(f"{base}/_summary/files/batch_id={batch_id}").select("file", "blocks")
    marks = rows.select(*key, _number()).join(sizes.select("blocks", _number()), "no")
    marks = marks.select("no", F.pmod(_hash(key, 3), "blocks").cast("int").alias("block"), F.explode(F.array(*[_probe(_hash(key, 2), i) for i in range(PROBES)])).alias("place"))
    bits = marks.groupBy("no", "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    bits = bits.join(sizes.select("file", _number()), "no").select("file", "block", "bits")
    bits.write.mode("overwrite").parquet(f"{base}/_summary/bloom/batch_id={batch_id}")


def _near(asked: DataFrame, files: DataFrame, key: list[str]) -> DataFrame:
    """(no, block, mark) of each key and each file of its bucket whose range holds it: there are as many rows as
    keys times batches, so they carry neither the key nor the file's path."""
    whole = F.struct(*key)
    near = asked.join(files.select("bucket", "lo", "hi", "blocks", _number()), "bucket").filter((F.col("lo") <= whole) & (whole <= F.col("hi")))
    return near.select("no", F.pmod(_hash(key, 3), "blocks").cast("int").alias("block"), _hash(key, 2).alias("mark"))


def candidate_files(keys: DataFrame, base: str, key, buckets: int = BUCKETS, before: int | None = None) -> list[str]:
    """Files that can hold one of the keys: in the key's bucket, its range and its Bloom filter.

    The names go to the driver, as those of a table's files do when Spark plans a scan of it."""
    key = list(key)
    spark = keys.sparkSession
    files, bloom = (_read(spark, f"{base}/_summary/{name}") for name in ("files", "bloom"))
    if files is None or bloom is None:
        return []
    if before is not None:
        files, bloom = files.filter(F.col("batch_id") < before), bloom.filter(F.col("batch_id") < before)
    asked = keys.select(*key).distinct().withColumn("bucket", F.pmod(_hash(key, 1), F.lit(buckets)).cast("int"))
    hit = _near(asked, files, key).join(bloom.select(_number(), "block", "bits"), ["no", "block"])
    for i in range(PROBES):
        hit = hit.filter(_bit(F.col("bits"), _probe(F.col("mark"), i)))
    found = files.select("file", _number()).join(hit.select("no").distinct(), "no", "left_semi")
    return sorted(r["file"] for r in found.select("file").distinct().collect())


def lookup(keys: DataFrame, base: str, schema: T.StructType, key, buckets: int = BUCKETS, before: int | None = None) -> DataFrame:
    """Stored rows (with their ``batch_id``) of the given keys, of batches before ``before``; reads candidate files only.

    NULL parts of a key match NULL."""
    key = list(key)
    spark = keys.sparkSession
    shape = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    # the keys are read twice: computed once
    asked = materialize_sized(keys.select(*key).distinct())
    files = candidate_files(asked, base, key, buckets, before)
    if not files:
        return spark.createDataFrame([], shape)
    rows = spark.read.schema(shape).option("basePath", base).parquet(*files)
    return rows.join(asked.select(F.struct(*key).alias("_asked")), F.struct(*key) == F.col("_asked"), "left_semi").select(*shape.fieldNames())


def stored(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame | None:
    """All rows of a store, without the columns of its layout; None where nothing is stored yet."""
    rows = _read(spark, base, schema)
    return None if rows is None else rows.select(*schema.fieldNames())
