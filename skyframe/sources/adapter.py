"""Weather-shaped observations over the shared TPC-H-like test tables.

The test tables hold no weather, so the staged (ODS) layer is derived from
them by joins and expressions, giving every district-day query real,
scale-growing input:

    district     <- region name of the supplier's nation
    year_mon_day <- ship date as ISO text
    max_t/min_t  <- quantity (and quantity - line number) with a degree unit
    weather      <- part type,  wind <- part name
    aqi          <- part size * 7, or '-' (missing) for low discounts

``l_orderkey, l_linenumber`` are kept as row identity (several rows share a
district-day here, unlike real input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..operators.joins import materialize_sized
from ..session import sf_path

ROW_ID = ["l_orderkey", "l_linenumber"]


def spread(df: DataFrame, keys) -> DataFrame:
    """Deal the rows of a scan of few large, unsplittable files out by a hash
    of ``keys`` (which keeps a re-run task's output identical), into as many
    partitions as the session shuffles into; adaptive execution joins small
    ones.  A scan that has a task for every core as it is stays where it is."""
    split = df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism
    return df if split else df.repartition(*keys)


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_on=None) -> DataFrame:
    """Scan a test table; with ``spread_on`` keys, spread an under-split scan."""
    df = spark.read.parquet(sf_path(sf_dir, name))
    return spread(df, spread_on) if spread_on else df


def supplier_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> region name; one row per supplier (nation and region keys are unique)."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nat = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reg = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nat_reg = nat.join(reg, nat.n_regionkey == reg.r_regionkey).select("n_nationkey", "r_name")
    return (sup.join(nat_reg, sup.s_nationkey == nat_reg.n_nationkey)
            .select("s_suppkey", F.col("r_name").alias("district")))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ODS-shaped rows (all text) + row identity.

    lineitem joins supplier and part on their keys; how each side is sent is
    Spark's choice by bytes (file statistics, then AQE at runtime).  At full
    scale both become shuffle joins on the key; part comes last, so that its
    texts are never shuffled with lineitem's rows.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate")
    li = spread(li, ["l_orderkey", "l_linenumber"])
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name", "p_size")
    # landed, so that Spark knows its bytes: a join is taken to be as large as the product of its sides
    sd = materialize_sized(supplier_district(spark, sf_dir))
    j = (li.join(sd, li.l_suppkey == sd.s_suppkey)
           .join(part, li.l_partkey == part.p_partkey))
    q = F.col("l_quantity").cast("int")
    weekdays = F.array(*[F.lit(w) for w in fixed.WEEKDAYS])
    return j.select(
        F.col("district"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("year_mon_day"),
        F.element_at(weekdays, F.dayofweek("l_shipdate")).alias("week"),
        F.concat(q.cast("string"), F.lit(fixed.DEGREE)).alias("max_t"),
        F.concat((q - F.col("l_linenumber")).cast("string"), F.lit(fixed.DEGREE)).alias("min_t"),
        F.col("p_type").alias("weather"),
        F.col("p_name").alias("wind"),
        F.when(F.col("l_discount") < 0.025, F.lit(fixed.MISSING_AQI))
         .otherwise((F.col("p_size") * 7).cast("string")).alias("aqi"),
        F.lit(None).cast("string").alias("aqi_type"),
        "l_orderkey", "l_linenumber",
    )


# DuckDB text of the same view, used by the oracle queries.
OBS_SQL = """
SELECT r_name AS district,
       strftime(l_shipdate, '%Y-%m-%d') AS year_mon_day,
       ['周日','周一','周二','周三','周四','周五','周六'][dayofweek(l_shipdate) + 1] AS week,
       CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '°' AS max_t,
       CAST(CAST(l_quantity AS INTEGER) - l_linenumber AS VARCHAR) || '°' AS min_t,
       p_type AS weather, p_name AS wind,
       CASE WHEN l_discount < 0.025 THEN '-' ELSE CAST(p_size * 7 AS VARCHAR) END AS aqi,
       CAST(NULL AS VARCHAR) AS aqi_type,
       l_orderkey, l_linenumber
FROM lineitem JOIN part ON l_partkey = p_partkey
     JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
"""
