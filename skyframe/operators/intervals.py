"""Joins on ranges.

An inequality join would compare every row with every range.  Here time is cut
into buckets of a fixed width: a point falls into one, a range into each that it
touches, and the join is an equality join on the bucket (and the keys), with
the range condition as a filter.  A bucket that holds many points (a busy day)
is one join key: its points are dealt over several shares, and the ranges that
touch it go to each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import materialize_sized

#: Points of one bucket and key in one share.
SHARE = 100_000


def interval_join(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, keys=(), width_s: int = 86_400, share: int = SHARE) -> DataFrame:
    """Rows of ``points`` and ``ranges`` with equal ``keys`` and ``low <= at <= high``, ends included.

    ``at``, ``low`` and ``high`` are timestamps; NULLs in them or in keys match nothing, and a range that
    ends before it begins holds nothing.  ``width_s`` should be about the length of a usual range: a
    range is copied once per bucket it touches.  No pair is lost or doubled: a point has one bucket
    and one share, a range one row in each."""
    keys = list(keys)
    clash = (set(points.columns) & set(ranges.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / width_s).cast("long")
    spots = points.withColumn("_bucket", bucket(at)).filter(F.col("_bucket").isNotNull())
    place = [*keys, "_bucket"]
    # keys and buckets that hold more points than a share does: few, whatever the rows are
    busy = materialize_sized(spots.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("_shares")).filter("_shares > 1"))
    spots = spots.join(busy, place, "left").withColumn("_share", F.when(F.col("_shares").isNotNull(), F.floor(F.rand(7) * F.col("_shares")).cast("int")).otherwise(0)).drop("_shares")
    reach = ranges.filter(F.col(low) <= F.col(high)).withColumn("_bucket", F.explode(F.sequence(bucket(low), bucket(high))))
    reach = reach.join(busy, place, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    return spots.join(reach, [*place, "_share"]).filter(F.col(at).between(F.col(low), F.col(high))).drop("_bucket", "_share")
