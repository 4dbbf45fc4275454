"""Landing of derived frames, and key filters.

How a side of a join is sent is left to Spark, which goes by bytes: file
sizes when it plans, shuffle sizes when adaptive execution plans again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import checkpoint_dir, scratch_path


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and checkpoint to the shared checkpoint folder (an eager
    reliable checkpoint writes while computing; no second pass)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_sized(df: DataFrame) -> DataFrame:
    """Compute once as Parquet under the shared checkpoint folder.  A lost
    executor re-reads it, and Spark knows its bytes: it broadcasts the frame
    within ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle
    beyond it."""
    path = scratch_path(df.sparkSession, "sized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keys_present(big: DataFrame, small: DataFrame, keys) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``small`` (a semi join; a ``big``
    that is bucketed by the keys is not shuffled)."""
    keys = list(keys)
    return big.join(small.select(*keys), keys, "left_semi")
