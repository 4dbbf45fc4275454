"""S8 across runs: a ledger of attempts.

A failed target is tried once more by the next run, and given up when that
fails too.  Within one frame ``dead_letter`` decides this; here every run folds
its attempts into a durable state of one row per target, so that the retry may
come in any later run:

    base/state/...      the state of every target touched by a run (a keyed store: only files that
                        can hold a touched target are read)
    base/dead/run=<n>   attempts that run <n> found to have failed twice in a row

Attempts of a run are taken to follow those of earlier runs.  A run's folders
are overwritten, and it sees the state that earlier runs left, so running it
again, with the same attempts, changes nothing; with others, it replaces what
it wrote, and later runs must be run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import keyed
from .joins import materialize_sized
from .ranking import next_in_group, nulls_last_struct


def _shape(attempts: DataFrame, key: list[str], status: str) -> T.StructType:
    """Columns of the state: the last attempt, and how many attempts of the target there were and failed."""
    return T.StructType([*attempts.schema.fields, T.StructField("attempts", T.LongType()), T.StructField("failures", T.LongType())])


def _newest(rows: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """The state of each target as its latest run left it."""
    last = rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in columns if c not in key]), "batch_id").alias("_last"))
    return last.select(*key, "_last.*").select(*columns)


def record_run(attempts: DataFrame, base: str, run: int, key, order, status: str = "status", fail_value: str = "error") -> DataFrame:
    """Fold a run's attempts (any columns; ``order`` sorts those of a target) into the ledger at ``base``.

    Returns the attempts, of this run or the last of an earlier one, that were given up in this run: they
    failed, and the next attempt of their target failed too.  A NULL target is a target, a NULL status is no
    failure.  Reads the state of the run's own targets only."""
    key, order, spark = list(key), list(order), attempts.sparkSession
    columns = attempts.columns
    shape = _shape(attempts, key, status)
    failed = lambda c: F.coalesce(F.col(c) == F.lit(fail_value), F.lit(False))
    # read by the lookup, the order of attempts and the counts: computed once
    new = materialize_sized(attempts)
    old = _newest(keyed.lookup(new, f"{base}/state", shape, key, before=run), key, shape.fieldNames())
    old = materialize_sized(old)
    chain = old.select(*columns, F.lit(0).alias("_turn")).unionByName(new.withColumn("_turn", F.lit(1)))
    following = next_in_group(chain, key, ["_turn", *order], [status], prefix="_next_")
    following = materialize_sized(following)
    dead = following.filter(failed(status) & F.col("_next_exists") & failed(f"_next_{status}")).select(*columns)
    dead.write.mode("overwrite").parquet(f"{base}/dead/run={run}")
    last = following.filter(~F.col("_next_exists")).select(*columns)
    counts = new.groupBy(*key).agg(F.count(F.lit(1)).alias("attempts"), F.count_if(failed(status)).alias("failures"))
    counts = counts.unionByName(old.select(*key, "attempts", "failures")).groupBy(*key).agg(F.sum("attempts").alias("attempts"), F.sum("failures").alias("failures"))
    one, other = F.struct(*key), F.col("_key")
    state = last.join(counts.select(F.struct(*key).alias("_key"), "attempts", "failures"), one == other).select(*columns, "attempts", "failures")
    keyed.append(state, f"{base}/state", run, key)
    return spark.read.schema(attempts.schema).parquet(f"{base}/dead/run={run}")


def target_state(spark: SparkSession, base: str, schema: T.StructType, key) -> DataFrame:
    """The last attempt of every target, with the numbers of its attempts and failures so far."""
    key = list(key)
    shape = T.StructType([*schema.fields, T.StructField("attempts", T.LongType()), T.StructField("failures", T.LongType())])
    rows = keyed.stored(spark, f"{base}/state", T.StructType([*shape.fields, T.StructField("batch_id", T.LongType())]))
    return spark.createDataFrame([], shape) if rows is None else _newest(rows, key, shape.fieldNames())


def retry_due(spark: SparkSession, base: str, schema: T.StructType, key, status: str = "status", fail_value: str = "error") -> DataFrame:
    """Targets whose last attempt failed: what the next run should try once more."""
    state = target_state(spark, base, schema, key)
    return state.filter(F.coalesce(F.col(status) == F.lit(fail_value), F.lit(False)))


def given_up(spark: SparkSession, base: str, schema: T.StructType, key, status: str = "status", fail_value: str = "error", closed: bool = False) -> DataFrame:
    """Failed attempts whose retry failed too, of all runs; if ``closed``, also those whose retry never came."""
    rows = keyed.stored(spark, f"{base}/dead", schema)
    rows = spark.createDataFrame([], schema) if rows is None else rows
    return rows.unionByName(retry_due(spark, base, schema, key, status, fail_value).select(*schema.fieldNames())) if closed else rows
