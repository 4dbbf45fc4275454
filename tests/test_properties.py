"""Property tests: batch-atomic and first-wins acceptance against a plain
Python statement of the rules, on random small inputs."""

from hypothesis import given, settings, strategies as st

from skyframe.operators.ingest import insert_batches, mark_batches

ROW = st.tuples(st.integers(0, 4), st.integers(0, 5))          # (batch, key)


def brute_atomic(rows, target_keys):
    """Batches one after another; each is stored whole or not at all."""
    stored, accepted = set(target_keys), []
    for batch in sorted({b for b, _ in rows}):
        keys = [k for b, k in rows if b == batch]
        if len(set(keys)) == len(keys) and None not in keys and not stored.intersection(keys):
            stored.update(keys)
            accepted += [i for i, (b, _) in enumerate(rows) if b == batch]
    return sorted(accepted)


def brute_first_wins(rows, target_keys):
    best = {}
    for i, (b, k) in enumerate(rows):
        if k not in best or (b, i) < best[k]:
            best[k] = (b, i)
    return sorted(i for k, (b, i) in best.items() if k not in target_keys)


def frames(spark, rows, target_keys):
    inc = spark.createDataFrame([(i, b, k) for i, (b, k) in enumerate(rows)] or [(0, 0, 0)][:0],
                                "id long, batch int, key int")
    tgt = spark.createDataFrame([(k,) for k in sorted(target_keys)], "key int")
    return inc, tgt


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=14), st.sets(st.integers(0, 5), max_size=2))
def test_atomic_matches_rules(spark, rows, target_keys):
    inc, tgt = frames(spark, rows, target_keys)
    m = mark_batches(tgt, inc, batch=["batch"], key=["key"], batch_order=["batch"])
    got = sorted(r.id for r in m.filter("accepted").collect())
    assert got == brute_atomic(rows, target_keys)
    assert m.count() == len(rows)                                  # accepted + rejected = input


@settings(max_examples=12, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=14), st.sets(st.integers(0, 5), max_size=2))
def test_first_wins_matches_rules(spark, rows, target_keys):
    inc, tgt = frames(spark, rows, target_keys)
    acc, rej = insert_batches(tgt, inc, ["batch"], ["key"], mode="first_wins", order=["batch", "id"])
    got = sorted(r.id for r in acc.collect())
    assert got == brute_first_wins(rows, target_keys)
    assert sorted(got + [r.id for r in rej.collect()]) == list(range(len(rows)))


ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.sampled_from(["a", "b", None])),
                min_size=1, max_size=40)


@settings(max_examples=10, deadline=None)
@given(ROWS, st.integers(1, 9))
def test_lead_and_rank_match_pandas(spark, rows, parts):
    import pandas as pd
    from skyframe.operators.ranking import global_rank, next_in_group
    data = [(i, k, t, s) for i, (k, t, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k int, t int, s string")
    pdf = pd.DataFrame(data, columns=["id", "k", "t", "s"]).sort_values(["k", "t", "id"]).reset_index(drop=True)
    nxt = pdf.groupby("k")["s"].shift(-1)
    has = pdf.groupby("k")["id"].shift(-1).notna()
    want = {int(r.id): (None if pd.isna(n) else n, bool(h)) for r, n, h in zip(pdf.itertuples(), nxt, has)}
    got = {r.id: (r.next_s, r.next_exists)
           for r in next_in_group(df, ["k"], ["t", "id"], ["s"], num_partitions=parts).collect()}
    assert got == want
    ranks = {r.id: r.rank for r in global_rank(df, ["k", "t", "id"], num_partitions=parts).collect()}
    assert ranks == {int(i): pos + 1 for pos, i in enumerate(pdf.id)}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y", None])), min_size=1, max_size=25),
       st.integers(1, 4))
def test_minus_one_copy_is_multiset_difference(spark, rows, chunk):
    from collections import Counter
    from skyframe.operators import ingest
    from skyframe.operators.ranking import replicate
    df = spark.createDataFrame(rows, "a int, b string")
    taken = spark.createDataFrame(sorted(set(rows), key=str)[:2], "a int, b string")
    got = Counter(map(tuple, ingest._minus_one_copy(df, taken).collect()))
    want = Counter(rows) - Counter(sorted(set(rows), key=str)[:2])
    assert got == want
    counted = spark.createDataFrame([(r, n) for r, n in Counter(rows).items()], "r struct<a:int,b:string>, n long")
    assert Counter(map(tuple, replicate(counted, "n", chunk=chunk).select("r.a", "r.b").collect())) == Counter(rows)
