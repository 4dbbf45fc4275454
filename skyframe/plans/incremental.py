"""C4/C8 in arrivals: the cleaned table kept up to date without reading all rows again.

The gap filling needs the mean AQI of each (district, calendar day) over all
years, so a new arrival changes old rows, but only rows without a value of their
own, and only those of the groups that it touches.  The table is kept in three
parts, named by one manifest per version (``sources.versions``):

* ``own``: cleaned rows that have a value; one folder per arrival, never rewritten.
* ``gaps``: rows without a value, as typed, with the value that the means give them now;
  partitioned by district and month.  An arrival rewrites the partitions whose groups it touches.
* ``means``: (sum, count) of every group; merged with those of each arrival.

An arrival is committed by its manifest, whole or not at all.  An arrival id
that a version already holds is not applied again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import month_day
from ..operators.clean import cast_aqi, cast_temperatures, classify_aqi, to_dwd
from ..operators.joins import materialize_sized
from ..schema import DWD
from ..sources import versions

GROUP = ["district", "_md"]
_MEANS = T.StructType([T.StructField("district", T.StringType()), T.StructField("_md", T.StringType()), T.StructField("total", T.DoubleType()), T.StructField("n", T.LongType())])


def _filled(gaps: DataFrame, means: DataFrame) -> DataFrame:
    """Rows without a value, with the rounded mean of their group, classified."""
    joined = gaps.join(means.select(*GROUP, (F.col("total") / F.col("n")).alias("_mean")), GROUP, "left")
    return classify_aqi(joined.withColumn("aqi", F.bround("_mean", 0)).drop("_mean"))


def _gaps(spark: SparkSession, base: str, parts: list[dict], schema: T.StructType) -> DataFrame:
    """Rows of the given gap partitions; each lies in the folder of the arrival that wrote it last."""
    by_folder: dict[str, list[str]] = {}
    for p in parts:
        by_folder.setdefault(p["folder"], []).append(f"{base}/{p['folder']}/{p['part']}")
    frames = [spark.read.schema(schema).option("basePath", f"{base}/{folder}").parquet(*paths).select(*schema.fieldNames()) for folder, paths in by_folder.items()]
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else spark.createDataFrame([], schema)


def _parts(spark: SparkSession, base: str, folder: str) -> list[dict]:
    """The partitions (district, month) that a folder holds."""
    return [{"folder": folder, "part": f"{d}/{m}"} for d in versions.list_names(spark, f"{base}/{folder}") if d.startswith("_district=")
            for m in versions.list_names(spark, f"{base}/{folder}/{d}")]


def add_arrival(ods: DataFrame, base: str, arrival: str, keep=(), on_null: str = "fail") -> int:
    """Clean an arrival of staged rows into the table at ``base``; returns the version that holds it.

    ``keep`` names columns carried along with the cleaned ones; they must be the same for all arrivals.
    After any number of arrivals the table equals one ``clean`` of all their rows."""
    spark = ods.sparkSession
    known = versions.versions(spark, base)
    last = versions.manifest(spark, base) if known else {"own": [], "gaps": [], "arrivals": {}}
    if arrival in last["arrivals"]:
        return last["arrivals"][arrival]
    shape = T.StructType([*DWD.fields, *[ods.schema[c] for c in keep]])
    typed = to_dwd(cast_aqi(cast_temperatures(ods, on_null=on_null)), keep=keep)
    typed = materialize_sized(typed.withColumn("_md", month_day("year_mon_day")))

    # means: this arrival's sums and counts, merged with the stored ones
    fresh = typed.filter(F.col("district").isNotNull() & F.col("_md").isNotNull()).groupBy(*GROUP).agg(F.sum("aqi").alias("total"), F.count("aqi").alias("n")).filter("n > 0")
    old = spark.read.schema(_MEANS).parquet(f"{base}/{last['means'][0]['folder']}") if known else spark.createDataFrame([], _MEANS)
    merged = old.unionByName(fresh).groupBy(*GROUP).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    means_folder = versions.write_folder(merged, base)["folder"]
    means = spark.read.schema(_MEANS).parquet(f"{base}/{means_folder}")

    # rows with a value are final: rounded and classified as they come
    own = classify_aqi(typed.filter("aqi IS NOT NULL").withColumn("aqi", F.bround("aqi", 0))).select(*shape.fieldNames())
    own_folder = versions.write_folder(own, base, sort_within=("district", "year_mon_day"))["folder"]

    # rows without one: those of this arrival, and the stored ones of the partitions it touches
    month = F.substring("_md", 1, 2)
    touched = {f"_district={_escaped(r['district'])}/_month={_escaped(r['m'])}" for r in typed.select("district", month.alias("m")).distinct().collect()}  # districts x months
    stay = [p for p in last["gaps"] if p["part"] not in touched]
    again = _gaps(spark, base, [p for p in last["gaps"] if p["part"] in touched], shape)
    gaps = again.unionByName(typed.filter("aqi IS NULL").select(*shape.fieldNames())).withColumn("_md", month_day("year_mon_day"))
    filled = _filled(gaps, means).select(*shape.fieldNames(), F.col("district").alias("_district"), month.alias("_month"))
    gap_folder = versions.write_folder(filled, base, partition_by=("_district", "_month"), sort_within=("year_mon_day",))["folder"]

    number = known[-1] + 1 if known else 1
    content = {"own": [*last["own"], {"folder": own_folder}], "gaps": [*stay, *_parts(spark, base, gap_folder)], "means": [{"folder": means_folder}],
               "schema": shape.jsonValue(), "arrivals": {**last["arrivals"], arrival: number}}
    return versions.commit(spark, base, content, expect=known[-1] if known else 0)


def _escaped(value: str | None) -> str:
    """A partition value as it stands in a path."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value)


#: Characters that Spark writes as %XX in partition paths.
_ESCAPED = frozenset("\"#%'*/:=?\\{[]^")


def read_cleaned(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """The cleaned table as a version has it (the latest by default)."""
    about = versions.manifest(spark, base, version)
    schema = T.StructType.fromJson(about["schema"])
    own = spark.read.schema(schema).parquet(*[f"{base}/{p['folder']}" for p in about["own"]])
    return own.unionByName(_gaps(spark, base, about["gaps"], schema))
