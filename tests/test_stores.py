"""What is kept between runs: versions, the keyed store, arrivals, the ledger; gaps in time and joins on ranges."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyframe.operators import intervals, ledger
from skyframe.operators.charts import timeline_filled
from skyframe.operators.clean import clean
from skyframe.operators.ingest import dead_letter
from skyframe.operators.ranking import carry_forward
from skyframe.plans import incremental
from skyframe.schema import ODS
from skyframe.session import scratch_path
from skyframe.sources import keyed, snapshot, versions


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------- versions

def test_a_failed_refresh_leaves_the_last_version(spark):
    base = scratch_path(spark, "t-versions")
    with pytest.raises(LookupError):
        versions.read_version(spark, base)
    one = spark.range(5).withColumn("v", F.lit("a"))
    assert versions.publish(one, base) == 1
    reader = versions.read_version(spark, base)
    broken = spark.range(100).withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("no")).cast("string")).otherwise("b"))
    with pytest.raises(PySparkException):
        versions.publish(broken, base)
    assert versions.versions(spark, base) == [1] and rows_of(versions.read_version(spark, base, verify=True)) == rows_of(one)
    assert versions.publish(spark.range(3).withColumn("v", F.lit(None).cast("string")), base, sort_within=("id",)) == 2
    assert versions.read_version(spark, base, verify=True).count() == 3 and reader.count() == 5
    with pytest.raises(versions.Conflict):
        versions.publish(one, base, expect=1)
    assert versions.rollback(spark, base, 1) == 3 and rows_of(versions.read_version(spark, base)) == rows_of(one)
    assert [tuple(r)[:4] for r in versions.history(spark, base).orderBy("version").collect()] == [(1, 0, None, 5), (2, 1, None, 3), (3, 2, 1, 5)]


def test_two_writers_never_take_one_version(spark):
    base = scratch_path(spark, "t-race")
    path = f"{base}/manifest/{1:020d}.json"
    assert versions.commit_file(spark, path, "{}") and not versions.commit_file(spark, path, "other")
    assert versions.read_file(spark, path) == "{}" and versions.list_names(spark, f"{base}/manifest") == [f"{1:020d}.json"]
    assert versions.commit(spark, base, {}) == 2


def test_expire_keeps_what_versions_name(spark):
    base = scratch_path(spark, "t-expire")
    for n in (1, 2, 3):
        versions.publish(spark.range(n), base)
    versions.rollback(spark, base, 2)
    versions.write_folder(spark.range(9), base)  # of a write that was not committed
    assert len(versions.expire(spark, base, keep=2)) == 1 and versions.versions(spark, base) == [3, 4]
    assert versions.read_version(spark, base, 3).count() == 3 and versions.read_version(spark, base).count() == 2
    assert len(versions.expire(spark, base, keep=1, unnamed_after_s=0)) == 2 and versions.read_version(spark, base, verify=True).count() == 2
    with pytest.raises(ValueError):
        versions.expire(spark, base, keep=0)


def test_a_changed_version_does_not_verify_and_snapshots_restore_into_versions(spark):
    base = scratch_path(spark, "t-verify")
    versions.publish(spark.range(4), base)
    spark.range(1).write.mode("append").parquet(f"{base}/{versions.manifest(spark, base)['folder']}")
    with pytest.raises(ValueError):
        versions.read_version(spark, base, verify=True)
    saved = snapshot.backup(spark.range(7), scratch_path(spark, "t-snap"))
    versions.restore_into(spark, saved, base)
    assert versions.read_version(spark, base, verify=True).count() == 7


# ----------------------------------------------------------------- keyed store

def test_a_check_opens_only_files_that_can_hold_a_key(spark):
    base = scratch_path(spark, "t-keyed")
    for batch in range(6):
        rows = spark.range(2000).select(F.lit(f"2020-0{batch + 1}").alias("day"), (F.col("id") * 7 + batch).alias("k"), F.lit(f"b{batch}").alias("v"))
        keyed.append(rows, base, batch, ["day", "k"], buckets=8)
    whole = keyed.stored(spark, base, rows.schema)
    assert whole.count() == 12_000 and len(whole.inputFiles()) == 48
    asked = spark.createDataFrame([("2020-03", 2 + 7 * 5), ("2020-03", 2 + 7 * 6), ("2020-05", 1), ("2030-01", 1)], "day string, k long")
    files = keyed.candidate_files(asked, base, ["day", "k"], buckets=8)
    assert 1 <= len(files) <= 3 and all("batch_id=2" in f or "batch_id=4" in f for f in files)
    found = keyed.lookup(asked, base, rows.schema, ["day", "k"], buckets=8)
    assert rows_of(found) == [("2020-03", 37, "b2", 2), ("2020-03", 44, "b2", 2)]
    names = lambda paths: {f.rsplit("/", 1)[1] for f in paths if "batch_id=" in f}
    assert names(found.inputFiles()) == names(files)
    assert keyed.lookup(asked, base, rows.schema, ["day", "k"], buckets=8, before=2).count() == 0
    # within one range the filters decide: few of the absent keys reach a file
    absent = spark.range(3000).select(F.lit("2020-01").alias("day"), (F.col("id") * 7 + 3).alias("k"))
    assert keyed.lookup(absent, base, rows.schema, ["day", "k"], buckets=8).count() == 0
    assert keyed.candidate_files(absent.limit(1), base, ["day", "k"], buckets=8) == []


def test_no_stored_key_is_missed_and_batches_replay(spark):
    base, r = scratch_path(spark, "t-keyed2"), random.Random(3)
    keys = [(r.choice([None, "a", "b"]), i if i % 50 else None) for i in range(1500)]
    df = spark.createDataFrame([(a, b, f"v{i}") for i, (a, b) in enumerate(keys)], "a string, b long, v string")
    for _ in range(2):
        keyed.append(df, base, 1, ["a", "b"])
    assert keyed.stored(spark, base, df.schema).count() == 1500
    assert keyed.lookup(df.select("a", "b"), base, df.schema, ["a", "b"]).count() == 1500
    assert keyed.lookup(df.select("a", "b"), scratch_path(spark, "t-none"), df.schema, ["a", "b"]).count() == 0
    keyed.append(df.limit(0), base, 2, ["a", "b"])
    assert keyed.lookup(df.limit(20), base, df.schema, ["a", "b"]).filter("batch_id = 1").count() >= 20


def test_rows_tested_per_key_carry_no_paths_and_equal_short_names_miss_nothing(spark, monkeypatch):
    def store(name):
        base = scratch_path(spark, name)
        for batch in range(2):
            rows = spark.range(400).select((F.col("id") * 2 + batch).alias("k"), F.lit(batch).alias("v"))
            keyed.append(rows, base, batch, ["k"], buckets=4)
        return base, rows.schema

    base, _ = store("t-narrow")
    asked = spark.range(10).select(F.col("id").alias("k"), F.lit(0).alias("bucket"))
    assert dict(keyed._near(asked, spark.read.parquet(f"{base}/_summary/files"), ["k"]).dtypes) == {"no": "bigint", "block": "int", "mark": "bigint"}
    monkeypatch.setattr(keyed, "_number", lambda file="file": F.lit(7).cast("long").alias("no"))
    base, schema = store("t-one-name")
    found = keyed.lookup(spark.range(0, 900, 3).select(F.col("id").alias("k")), base, schema, ["k"], buckets=4)
    assert rows_of(found) == sorted(((k, k % 2, k % 2) for k in range(0, 800, 3)), key=str)


# ------------------------------------------------------------------- arrivals

def _ods(seed, n, months=("01", "02", "03")):
    r = random.Random(seed)
    return [(r.choice(["朝阳", "昌平", "a/b=c", None]), f"20{r.randint(10, 24)}-{r.choice(months)}-0{r.randint(1, 4)}", None, f"{r.randint(0, 30)}°", "-1°", "晴", "北风",
             r.choice(["-", "", None, str(r.randint(1, 400)), f"{r.randint(1, 99)}.5"]), None) for _ in range(n)]


def test_arrivals_equal_one_clean_and_touch_few_files(spark):
    base = scratch_path(spark, "t-arrivals")
    parts = [_ods(1, 300), _ods(2, 40, months=("02",)), _ods(3, 30, months=("05",)), []]
    for n, part in enumerate(parts):
        df = spark.createDataFrame(part, ODS)
        number = incremental.add_arrival(df, base, f"a{n}")
        before = versions.manifest(spark, base, number - 1) if n else None
        now = versions.manifest(spark, base)
        if n == 1:
            # only the gaps of February are written again, and no row that has a value
            same = {p["part"] for p in now["gaps"]} & {p["part"] for p in before["gaps"] if p in now["gaps"]}
            assert same and all(not p.endswith("_month=02") for p in same)
            assert all(p["part"].endswith("_month=02") for p in now["gaps"] if p not in before["gaps"]) and now["own"][:1] == before["own"]
        assert incremental.add_arrival(df, base, f"a{n}") == number  # sent again
        assert rows_of(incremental.read_cleaned(spark, base)) == rows_of(clean(spark.createDataFrame(sum(parts[:n + 1], []), ODS)))
    assert rows_of(incremental.read_cleaned(spark, base, 1)) == rows_of(clean(spark.createDataFrame(parts[0], ODS)))


# --------------------------------------------------------------------- ledger

def test_the_ledger_equals_dead_letter_over_all_runs(spark):
    r, base = random.Random(5), scratch_path(spark, "t-ledger")
    shape = "url string, n int, status string"
    rows = [(r.choice(["u1", "u2", "u3", "u4", None]), n, r.choice(["403", "403", "ok", None])) for n in range(60)]
    frames = [spark.createDataFrame(rows[a:b], shape) for a, b in ((0, 20), (20, 21), (21, 40), (40, 60))]
    for run in (1, 2, 2, 3, 4, 4):
        ledger.record_run(frames[run - 1], base, run, ["url"], ["n"], fail_value="403")
        told = ledger.given_up(spark, base, frames[0].schema, ["url"], fail_value="403", closed=True)
        want = dead_letter(spark.createDataFrame(rows[:(20, 21, 40, 60)[run - 1]], shape), ["url"], ["n"], fail_value="403")
        assert rows_of(told) == rows_of(want)
    last = {u: max(n for v, n, _ in rows if v == u) for u in {u for u, _, _ in rows}}
    state = {s.url: s for s in ledger.target_state(spark, base, frames[0].schema, ["url"]).collect()}
    assert {u: (s.n, s.attempts, s.failures) for u, s in state.items()} == {u: (n, sum(v == u for v, _, _ in rows), sum(v == u and s == "403" for v, _, s in rows)) for u, n in last.items()}
    due = ledger.retry_due(spark, base, frames[0].schema, ["url"], fail_value="403")
    assert {d.url for d in due.collect()} == {u for u, n in last.items() if rows[n][2] == "403"}


# ------------------------------------------------------------- time and ranges

@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_values_are_carried_over_task_borders(spark, tasks):
    r = random.Random(tasks)
    rows = [(r.choice(["a", "a", "a", "b", None]), i, r.choice([None, None, None, i])) for i in range(300)]
    got = carry_forward(spark.createDataFrame(rows, "g string, i int, v int"), ["g"], ["i"], "v", num_partitions=tasks).collect()
    seen, want = {}, set()
    for g, i, v in rows:
        seen[g] = v if v is not None else seen.get(g)
        want.add((g, i, seen[g]))
    assert {tuple(x) for x in got} == want


def test_timelines_without_gaps(spark):
    df = spark.createDataFrame([("a", "2020-02-27", 1), ("a", "2020-03-02", None), ("b", "2020-03-01", 5)], "k string, day string, v int")
    got = rows_of(timeline_filled(df, ["k"], "day", ["v"], high="2020-03-03"))
    assert got == sorted([("a", f"2020-{d}", 1, "2020-02-27") for d in ("02-27", "02-28", "02-29", "03-01")] + [("a", f"2020-03-0{d}", None, "2020-03-02") for d in (2, 3)]
                         + [("b", f"2020-{d}", None, None) for d in ("02-27", "02-28", "02-29")] + [("b", f"2020-03-0{d}", 5, "2020-03-01") for d in (1, 2, 3)], key=str)
    assert timeline_filled(df.limit(0), ["k"], "day", ["v"]).collect() == []


def test_interval_join_equals_brute_force(spark):
    r = random.Random(9)
    points = [(i, r.choice(["x", "y", None]), r.choice([None, 1000, r.randint(-500_000, 500_000)])) for i in range(400)]
    ranges = [(j, r.choice(["x", "y", None]), a, a + r.choice([-5, 0, 10, 90_000, 400_000])) for j in range(60) for a in [r.randint(-500_000, 500_000)]] + [(99, "x", 1000, 1000), (98, "x", None, 5)]
    p = spark.createDataFrame(points, "i int, k string, s long").select("i", "k", F.timestamp_seconds("s").alias("t"))
    q = spark.createDataFrame(ranges, "j int, k string, a long, b long").select("j", "k", F.timestamp_seconds("a").alias("a"), F.timestamp_seconds("b").alias("b"))
    for share in (5, 1000):
        keyed_join = intervals.interval_join(p, q, "t", "a", "b", keys=["k"], width_s=30_000, share=share)
        assert rows_of(keyed_join.select("i", "j")) == sorted([(i, j) for i, k, s in points for j, m, a, b in ranges if k is not None and k == m and None not in (s, a) and a <= s <= b], key=str)
        free = intervals.interval_join(p.drop("k"), q.drop("k"), "t", "a", "b", width_s=100_000, share=share)
        assert rows_of(free.select("i", "j")) == sorted([(i, j) for i, _, s in points for j, _, a, b in ranges if None not in (s, a) and a <= s <= b], key=str)
        plan = keyed_join._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        intervals.interval_join(p, q, "t", "a", "b")
