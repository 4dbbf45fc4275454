"""Staged text with bad lines: good rows are loaded, bad lines are set aside with
the rule that they break and the place where they stand.

The text is scanned once.  Every line is parsed by Spark's own CSV expression,
marked, and written to one Parquet folder split by mark; good rows, rejects and
counts are read from there.  A line's place is its first byte in its file.
Files are read in blocks, so a place is the bytes of the file's earlier blocks
and of the block's earlier lines; it is worked out from line lengths alone, and
only for files that hold a bad line.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .staged import NULL, SEP, _marked, _opts

_WHERE = ("_mark", "_rule", "_line", "_file", "_block", "_seq", "_bytes")


class Loaded(NamedTuple):
    good: DataFrame
    rejects: DataFrame  # file, place, rule, line
    counts: DataFrame  # rule, n


def _parsed(line: Column, schema: T.StructType, sep: str, null: str) -> Column:
    options = {**_opts(sep, null), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    return F.from_csv(line, T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]).toDDL(), options)


def load_quarantined(spark: SparkSession, path: str, schema: T.StructType, out: str, rules: dict[str, Column] | None = None,
                     sep: str = SEP, null: str = NULL) -> Loaded:
    """Load staged text of ``schema``; ``out`` is a fresh folder for the marked rows.

    A line is rejected as ``arity`` if it has another number of fields, as
    ``type`` if a field does not read as its type, and by the first of ``rules``
    ({name: condition that good rows meet}) that does not hold (null does not).
    Blank lines are no rows, as for other readers.  Lines end in ``\\n``; a record
    cannot span lines (staging drops line breaks).  An empty folder of text gives
    empty tables.  Columns must not be called like one of the marks (``_mark``,
    ``_rule``, ``_line``, ``_file``, ``_block``, ``_seq``, ``_bytes``, ``_bad``): ValueError."""
    clash = sorted({c.lower() for c in schema.fieldNames()} & {*_WHERE, "_bad"})
    if clash:
        raise ValueError(f"columns are called like marks: {clash}")
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"), (F.octet_length("value") + 1).cast("long").alias("_bytes"))
    rows = lines.withColumn("_row", _parsed(F.col("_line"), schema, sep, null))
    broken = F.col("_row._bad").isNotNull()
    arity = _parsed(F.col("_line"), texts, sep, null)["_bad"].isNotNull()
    rows = rows.select("_line", "_file", "_block", "_seq", "_bytes", broken.alias("_broken"), F.when(broken, arity).alias("_arity"), *[F.col("_row")[n].alias(n) for n in schema.fieldNames()])
    rows = _marked(rows, null, undo=True, only=schema.fieldNames())
    rule = F.when(F.trim("_line") == "", F.lit(None)).when(F.col("_arity"), F.lit("arity")).when(F.col("_broken"), F.lit("type"))
    for name, holds in (rules or {}).items():
        rule = rule.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
    rows = rows.withColumn("_rule", rule)
    mark = F.when(F.trim("_line") == "", F.lit("blank")).when(F.col("_rule").isNotNull(), F.lit("bad")).otherwise(F.lit("good"))
    rows = rows.withColumn("_mark", mark).withColumn("_line", F.when(F.col("_mark") == "bad", F.col("_line"))).drop("_broken", "_arity")
    rows.write.partitionBy("_mark").parquet(out)
    kept = spark.read.schema(rows.schema).parquet(out)
    bad = kept.filter("_mark = 'bad'")
    return Loaded(kept.filter("_mark = 'good'").select(*schema.fieldNames()), _placed(kept, bad), bad.groupBy(F.col("_rule").alias("rule")).agg(F.count(F.lit(1)).alias("n")))


def _placed(kept: DataFrame, bad: DataFrame) -> DataFrame:
    """Bad lines with their first byte.  Both windows are bounded: lines of one block, blocks of one file."""
    touched = bad.select("_file").distinct()
    sizes = kept.select("_file", "_block", "_seq", "_bytes", "_mark", "_rule", "_line").join(touched, "_file", "left_semi")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("_file", "_block").agg(F.sum("_bytes").alias("_size"))
    blocks = blocks.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), F.coalesce(F.sum("_size").over(earlier.partitionBy("_file").orderBy("_block")), F.lit(0)).alias("_before"))
    inside = sizes.withColumn("_within", F.coalesce(F.sum("_bytes").over(earlier.partitionBy("_file", "_block").orderBy("_seq")), F.lit(0))).filter("_mark = 'bad'")
    found = inside.join(blocks, (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return found.select(F.col("_file").alias("file"), (F.col("_before") + F.col("_within")).alias("place"), F.col("_rule").alias("rule"), F.col("_line").alias("line"))
