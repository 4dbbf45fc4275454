"""Order-dependent operators that stay parallel when one group is huge.

A window ``PARTITION BY key ORDER BY ...`` sends every row of a key to one
task; with a key holding a third of the data that task does a third of the
work.  These helpers avoid per-key windows:

* ``first_per_key`` — the first row of each key as a ``min(struct(...))``
  aggregate, which Spark combines map-side before the shuffle, so a hot
  key arrives pre-reduced.
* ``global_rank`` — a 1-based row number over a total order: range
  partitioning on the full order splits hot keys across tasks; each task
  numbers its sorted rows; per-partition counts turn into offsets (one row
  per partition, a proven bound) that are broadcast.  The numbered rows are
  landed as Parquet in the shared checkpoint folder first, so counts and
  numbers come from the same data (two plans over one range exchange would
  sample their bounds separately), the count reads one column, and a lost
  executor does not re-run the sort.
* ``next_in_group`` — the next row of the same group in order (``lead``):
  rows range-partitioned and numbered as above; ``lead`` within each task
  (tasks are balanced by the range split) and, for each task's last row,
  the first row of the next non-empty task (one row per task, broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import materialize_sized


def _sort_col(c) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def nulls_last_struct(cols) -> Column:
    """A struct that sorts by ``cols`` with NULLs after all values."""
    return F.struct(*[x for c in cols for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))])


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the smallest by ``order``, NULLs last (remaining
    columns break ties, so the choice is deterministic)."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = nulls_last_struct(order + rest).alias("_first")
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return picked.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns)


def global_rank(df: DataFrame, order, name: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number over ``order`` (ascending, NULLs last for
    names; pass Columns for other directions).  ``order`` should be unique
    per row for a deterministic result."""
    numbered = _range_numbered(df, order, num_partitions)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + local + F.lit(1))
            .drop("_pid", "_mid", "_off"))


def _range_numbered(df: DataFrame, order, num_partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted rows with their partition id and in-partition
    id, landed (see the module notes)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [_sort_col(c) for c in order]
    return materialize_sized(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                             .withColumn("_pid", F.spark_partition_id())
                             .withColumn("_mid", F.monotonically_increasing_id()))


def next_in_group(df: DataFrame, group, order, values, prefix: str = "next_",
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``prefix + v`` for each value column: the value of the next row of
    the same group in ``order`` (NULL on a group's last row), plus
    ``prefix + 'exists'``.

    The rows are range-partitioned and sorted on (group, order); the next
    row is the next one in the same task, except for each task's last row,
    whose next row is the first row of the next non-empty task.  Those
    first rows (one per task, a bound fixed by the partition count) are
    broadcast.  No per-group window: a group spanning many tasks is handled
    like any other.
    """
    group, values = list(group), list(values)
    carried = group + values
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = _range_numbered(df, group + list(order), n)
    in_task = Window.partitionBy("_pid").orderBy("_mid")
    # each slice goes to a task of its own, by its number
    local = numbered.repartitionById(n, "_pid").select(
        "*", *[F.lead(c).over(in_task).alias(f"_n_{c}") for c in carried],
        F.lead(F.lit(True)).over(in_task).alias("_nx"))
    local_index = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    heads = numbered.filter(local_index == 0).select("_pid", *carried)
    by_task = Window.orderBy("_pid")
    next_head = heads.select(
        "_pid", *[F.lead(c).over(by_task).alias(f"_h_{c}") for c in carried],
        F.lead(F.lit(True)).over(by_task).alias("_hx"))
    j = local.join(F.broadcast(next_head), "_pid", "left")
    last = F.col("_nx").isNull()
    j = j.withColumns({**{f"_n_{c}": F.when(last, F.col(f"_h_{c}")).otherwise(F.col(f"_n_{c}")) for c in carried},
                       "_nx": F.when(last, F.col("_hx")).otherwise(F.col("_nx"))})
    same = F.coalesce(F.col("_nx"), F.lit(False))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_n_{g}"))
    out = j.withColumns({f"{prefix}{v}": F.when(same, F.col(f"_n_{v}")) for v in values})
    out = out.withColumn(f"{prefix}exists", same)
    return out.select(*df.columns, *[f"{prefix}{v}" for v in values], f"{prefix}exists")


def carry_forward(df: DataFrame, group, order, value: str, num_partitions: int | None = None) -> DataFrame:
    """``df`` with NULLs of ``value`` replaced by the last value before them in the same group in ``order``
    (they stay NULL before a group's first).

    Rows are range-partitioned on (group, order).  Values are carried within each task; each task's
    last group and value (one row per task) are carried from task to task, and what comes into a task
    goes to the rows of its first group that have no value before them."""
    group = list(group)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = _range_numbered(df, group + list(order), n)
    key = F.struct(*[x for g in group for x in (F.col(g).isNull(), F.col(g))])
    in_task = Window.partitionBy("_pid", "_group").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = numbered.withColumn("_group", key).repartitionById(n, "_pid").withColumn("_carried", F.last(value, ignorenulls=True).over(in_task))
    # one row per task: its first and last group, and the last value of the last group
    ends = numbered.select("_pid", "_mid", key.alias("_group"), value).groupBy("_pid").agg(F.min_by("_group", "_mid").alias("_first"), F.max_by("_group", "_mid").alias("_last"))
    tails = (numbered.select("_pid", "_mid", key.alias("_group"), F.col(value).alias("_v")).filter(F.col("_v").isNotNull()).groupBy("_pid", "_group").agg(F.max_by("_v", "_mid").alias("_v")))
    ends = ends.join(tails.select(F.col("_pid").alias("_p"), F.col("_group").alias("_g"), "_v"), (F.col("_pid") == F.col("_p")) & (F.col("_last") == F.col("_g")), "left")
    # the nearest earlier task that ends in this task's first group with a value
    by_task = Window.partitionBy("_last").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    ends = materialize_sized(ends.withColumn("_so_far", F.last("_v", ignorenulls=True).over(by_task)).select("_pid", "_first", "_last", "_so_far"))
    into = ends.alias("t").join(ends.alias("e"), (F.col("t._first") == F.col("e._last")) & (F.col("e._pid") < F.col("t._pid")))
    into = into.groupBy(F.col("t._pid").alias("_pid"), F.col("t._first").alias("_group")).agg(F.max_by("e._so_far", "e._pid").alias("_before"))
    out = local.join(F.broadcast(into), ["_pid", "_group"], "left")
    return out.withColumn(value, F.coalesce("_carried", "_before")).select(*df.columns)


def replicate(df: DataFrame, count_col: str, chunk: int = 100_000) -> DataFrame:
    """Each row ``count_col`` times (the column is dropped).  Large counts are
    first cut into chunks, which are spread over tasks by hash before they
    are expanded, so one row with a huge count is not expanded by one task."""
    cols = [c for c in df.columns if c != count_col]
    n = F.col(count_col)
    chunks = df.filter(n > 0).select(
        *cols, n.alias("_n"), F.explode(F.sequence(F.lit(0), ((n - 1) / F.lit(chunk)).cast("long"))).alias("_chunk"))
    spread = chunks.repartition(F.xxhash64(*[F.col(c) for c in cols], F.col("_chunk")))
    size = F.least(F.lit(chunk).cast("long"), F.col("_n") - F.col("_chunk") * F.lit(chunk))
    return spread.select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_i")).drop("_i")
