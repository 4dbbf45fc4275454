"""Skew-safe ordering operators against brute force, on a fixture where one
key holds a third of the rows."""

import pandas as pd

from skyframe.operators.ranking import first_per_key, global_rank, next_in_group


def skewed(spark, n=3000):
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else (i % 97) + 1   # key 0 holds a third of the rows
        rows.append((i, key, (i * 7919) % 1000, "e" if i % 5 == 0 else "o"))
    return spark.createDataFrame(rows, "id long, k long, t long, s string")


def test_global_rank_is_row_number(spark):
    df = skewed(spark)
    got = {r.id: r.rank for r in global_rank(df, ["k", "t", "id"], num_partitions=7).collect()}
    pdf = df.toPandas().sort_values(["k", "t", "id"]).reset_index(drop=True)
    want = {int(i): pos + 1 for pos, i in enumerate(pdf.id)}
    assert got == want


def test_global_rank_spreads_hot_key(spark):
    df = skewed(spark)
    from pyspark.sql import functions as F
    ranked = global_rank(df, ["k", "t", "id"], num_partitions=6)
    # rows of the hot key are numbered 1..1000 without gaps
    hot = sorted(r.rank for r in ranked.filter("k = 0").collect())
    assert hot == list(range(1, 1001))
    # and the range partitioning put them into more than one task
    parts = df.repartitionByRange(6, "k", "t", "id").filter("k = 0").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


def test_next_in_group_is_lead(spark):
    df = skewed(spark)
    got = {r.id: (r.next_s, r.next_exists) for r in next_in_group(df, ["k"], ["t", "id"], ["s"]).collect()}
    pdf = df.toPandas().sort_values(["k", "t", "id"])
    pdf["nxt"] = pdf.groupby("k")["s"].shift(-1)
    want = {int(r.id): (None if pd.isna(r.nxt) else r.nxt, not pd.isna(r.nxt)) for r in pdf.itertuples()}
    assert got == want


def test_first_per_key_matches_brute_force(spark):
    df = skewed(spark)
    got = sorted(map(tuple, first_per_key(df, ["k"], ["t", "id"]).collect()))
    pdf = df.toPandas().sort_values(["k", "t", "id"]).groupby("k").head(1)
    want = sorted((int(a), int(b), int(c), d) for a, b, c, d in pdf[["id", "k", "t", "s"]].itertuples(index=False))
    assert got == want


def test_lead_across_empty_tasks(spark):
    rows = [(1, "a", 1, "x"), (2, "a", 2, "y"), (3, "a", 3, "z"), (4, "b", 1, "u"), (5, "b", 2, "v")]
    df = spark.createDataFrame(rows, "id long, k string, t long, s string")
    for n in (1, 3, 8, 16):
        got = {r.id: (r.next_s, r.next_exists) for r in next_in_group(df, ["k"], ["t"], ["s"], num_partitions=n).collect()}
        assert got == {1: ("y", True), 2: ("z", True), 3: (None, False), 4: ("v", True), 5: (None, False)}, n
        ranks = {r.id: r.rank for r in global_rank(df, ["k", "t"], num_partitions=n).collect()}
        assert ranks == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5}, n
