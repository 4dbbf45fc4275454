"""Queries over what is kept between runs: published versions, the keyed store, the
cleaned table in arrivals, the attempt ledger, staged tables, and sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import clean as C, ingest, intervals, ledger
from ..operators.charts import rollup_levels, timeline_filled
from ..schema import ODS
from ..session import scratch_path
from ..sources import keyed, quarantine, tables, versions
from ..sources.adapter import ROW_ID, read_table
from ..streaming.ingest import ingest_pages_stream
from . import incremental, registry as R
from .jobs import stage_job


def _must_fail(write: Callable[[], object]) -> None:
    """Run a write that is meant to fail half-way."""
    try:
        write()
    except PySparkException:
        return
    raise AssertionError("the write did not fail")


def _breaks(df: DataFrame, key: str) -> DataFrame:
    """``df``, but some of its rows cannot be computed."""
    harm = F.when(F.pmod(F.xxhash64(key), F.lit(50)) == 0, F.raise_error(F.lit("meant to fail")).cast("long"))
    return df.withColumn(key, F.coalesce(harm, F.col(key)))


@R.register("atomic_refresh", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice, CAST(2 AS BIGINT) AS version FROM orders")
def q_atomic_refresh(spark, sf):
    # two refreshes, each followed by one that fails half-way: readers see the second
    base = scratch_path(spark, "published-orders")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    versions.publish(orders, base, sort_within=("o_orderkey",))
    _must_fail(lambda: versions.publish(_breaks(orders, "o_orderkey"), base))
    number = versions.publish(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), base, sort_within=("o_orderkey",), expect=1)
    _must_fail(lambda: versions.publish(_breaks(orders, "o_orderkey"), base))
    return versions.read_version(spark, base, verify=True).withColumn("version", F.lit(number).cast("long"))


@R.register("version_rollback", """
SELECT 'now' AS reader, s_suppkey, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT 'pinned' AS reader, s_suppkey, s_nationkey, s_acctbal + 1 AS s_acctbal FROM supplier""")
def q_version_rollback(spark, sf):
    # a reader pinned to the second version keeps it when the table goes back to the first
    base = scratch_path(spark, "published-supplier")
    rows = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    versions.publish(rows, base, partition_by=("s_nationkey",), sort_within=("s_suppkey",))
    versions.publish(rows.withColumn("s_acctbal", F.col("s_acctbal") + 1), base, partition_by=("s_nationkey",), sort_within=("s_suppkey",))
    pinned = versions.read_version(spark, base)
    versions.rollback(spark, base, 1)
    now = versions.read_version(spark, base, verify=True)
    return now.select(F.lit("now").alias("reader"), "*").unionByName(pinned.select(F.lit("pinned").alias("reader"), "*"))


@R.register("version_history", """
SELECT CAST(v AS BIGINT) AS version, CAST(v - 1 AS BIGINT) AS previous, CAST(CASE WHEN v = 3 THEN 1 END AS BIGINT) AS rollback_to,
       (SELECT count(*) FROM customer WHERE v <> 2 OR c_acctbal > 0) AS n_rows FROM range(1, 4) t(v)""")
def q_version_history(spark, sf):
    base = scratch_path(spark, "published-customer")
    rows = read_table(spark, sf, "customer")
    versions.publish(rows, base)
    versions.publish(rows.filter("c_acctbal > 0"), base)
    versions.rollback(spark, base, 1)
    return versions.history(spark, base).drop("checksum")


@R.register("keyed_lookup", """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS batch_id FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_keyed_lookup(spark, sf):
    # a batch per year, then the stored orders of all returned items
    base = scratch_path(spark, "keyed-orders")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    years = sorted(r["y"] for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect())
    rows = orders.drop("o_orderdate")
    for y in years:
        keyed.append(orders.filter(F.year("o_orderdate") == y).drop("o_orderdate"), base, y, ["o_orderkey"])
    asked = read_table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return keyed.lookup(asked, base, rows.schema, ["o_orderkey"])


_ARRIVALS = (("early", "0000", "1996"), ("middle", "1996", "1998"), ("middle", "1996", "1998"), ("late", "1998", "9999"))


@R.register("clean_arrivals", R.WITH_DWD + f"\nSELECT {R.DWD_COLS} FROM dwd")
def q_clean_arrivals(spark, sf):
    # three arrivals of staged rows, one of them sent twice
    base, staged = scratch_path(spark, "cleaned"), R.ods(spark, sf)
    for name, low, high in _ARRIVALS:
        part = staged.filter((F.col("year_mon_day") >= low) & (F.col("year_mon_day") < high))
        incremental.add_arrival(part, base, name, keep=ROW_ID)
    return incremental.read_cleaned(spark, base)


_LEDGERS: dict[tuple[str, str], tuple] = {}


def _recorded(spark, sf):
    """Events as attempts, in three runs by time; the second is run twice.  Returns (base, schema, key);
    recorded once per application."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in _LEDGERS:
        _LEDGERS[name] = _record(spark, sf)
    return _LEDGERS[name]


def _record(spark, sf):
    base, key = scratch_path(spark, "ledger"), ["user_id"]
    events = read_table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    third = (span["b"] - span["a"]) / 3
    cuts = [span["a"] + third, span["a"] + 2 * third]
    at = lambda c: F.lit(c).cast(events.schema["ts"].dataType)
    parts = [events.filter(F.col("ts") < at(cuts[0])), events.filter((F.col("ts") >= at(cuts[0])) & (F.col("ts") < at(cuts[1]))), events.filter(F.col("ts") >= at(cuts[1]))]
    for run, part in ((1, parts[0]), (2, parts[1]), (2, parts[1]), (3, parts[2])):
        ledger.record_run(part, base, run, key, ["ts", "event_id"], status="event_type", fail_value="error")
    return base, events.schema, key


@R.register("attempt_ledger", R.ORACLE["dead_letter"])
def q_attempt_ledger(spark, sf):
    base, schema, key = _recorded(spark, sf)
    return ledger.given_up(spark, base, schema, key, status="event_type", closed=True)


@R.register("attempt_state", """
SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
       count(*) AS attempts, count(*) FILTER (WHERE event_type = 'error') AS failures
FROM events GROUP BY user_id""")
def q_attempt_state(spark, sf):
    base, schema, key = _recorded(spark, sf)
    return ledger.target_state(spark, base, schema, key)


# ------------------------------------------------------- charts and joins

@R.register("timeline_filled", """
WITH obs AS (SELECT s_nationkey AS nation, strftime(l_shipdate, '%Y-%m-%d') AS day, avg(l_quantity) AS quantity
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
span AS (SELECT min(CAST(day AS DATE)) AS a, max(CAST(day AS DATE)) AS b FROM obs),
spine AS (SELECT nation, strftime(CAST(d AS DATE), '%Y-%m-%d') AS day FROM (SELECT DISTINCT nation FROM obs), (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM span))
SELECT s.nation, s.day, o.quantity, o.day AS filled_from FROM spine s ASOF LEFT JOIN obs o ON s.nation = o.nation AND s.day >= o.day""")
def q_timeline_filled(spark, sf):
    items = read_table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    suppliers = read_table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    obs = (items.join(suppliers, items.l_suppkey == suppliers.s_suppkey)
           .groupBy("nation", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day")).agg(F.avg("l_quantity").alias("quantity")))
    return timeline_filled(obs, ["nation"], "day", ["quantity"])


@R.register("rollup_levels", R.WITH_DWD + """
, g AS (SELECT district, substr(year_mon_day, 1, 4) AS y, substr(year_mon_day, 1, 7) AS m, year_mon_day AS d, max_t, min_t, aqi FROM dwd),
r AS (SELECT district, y, m, d, grouping(y) AS gy, grouping(m) AS gm, grouping(d) AS gd, count(*) AS n, avg(max_t) AS avg_max_t, max(max_t) AS max_max_t, min(min_t) AS min_min_t, avg(aqi) AS avg_aqi
      FROM g GROUP BY GROUPING SETS ((district, y, m, d), (district, y, m), (district, y), (district)))
SELECT district, CASE WHEN gd = 0 THEN 'day' WHEN gm = 0 THEN 'month' WHEN gy = 0 THEN 'year' ELSE 'all' END AS grain,
       CASE WHEN gd = 0 THEN d WHEN gm = 0 THEN m WHEN gy = 0 THEN y ELSE '' END AS period, n, avg_max_t, max_max_t, min_min_t, avg_aqi FROM r""")
def q_rollup_levels(spark, sf):
    return rollup_levels(R.dwd(spark, sf))


@R.register("interval_join", """
SELECT b.event_id AS error_id, e.event_id FROM events b JOIN events e ON e.user_id = b.user_id AND e.ts >= b.ts AND e.ts <= b.ts + INTERVAL 1 DAY
WHERE b.event_type = 'error' AND e.event_type <> 'error'""")
def q_interval_join(spark, sf):
    # what a user did within a day of an error
    events = read_table(spark, sf, "events").select("event_id", F.col("user_id").alias("who"), "ts", "event_type")
    errors = events.filter("event_type = 'error'").select(F.col("event_id").alias("error_id"), "who", F.col("ts").alias("low"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("high"))
    return intervals.interval_join(events.filter("event_type <> 'error'"), errors, "ts", "low", "high", keys=["who"], width_s=86_400).select("error_id", "event_id")


@R.register("interval_join_days", R.WITH_DWD + """
, w AS (SELECT r_name AS district, DATE '1995-01-01' + CAST(30 * r_regionkey AS INTEGER) AS low, DATE '1995-03-01' + CAST(200 * r_regionkey AS INTEGER) AS high FROM region)
SELECT d.l_orderkey, d.l_linenumber, d.district, w.district AS season_of, d.aqi FROM dwd d JOIN w ON CAST(d.year_mon_day AS DATE) BETWEEN w.low AND w.high""")
def q_interval_join_days(spark, sf):
    # no equal key at all: every observation with each of the seasons that hold its day
    region = read_table(spark, sf, "region")
    start = lambda day, step: F.date_add(F.lit(day).cast("date"), (F.col("r_regionkey") * step).cast("int")).cast("timestamp_ntz")
    seasons = region.select(F.col("r_name").alias("season_of"), start("1995-01-01", 30).alias("low"), start("1995-03-01", 200).alias("high"))
    obs = R.dwd(spark, sf).select(*ROW_ID, "district", "aqi", F.to_date("year_mon_day").cast("timestamp_ntz").alias("at"))
    return intervals.interval_join(obs, seasons, "at", "low", "high", width_s=64 * 86_400).select(*ROW_ID, "district", "season_of", "aqi")


# --------------------------------------------------- paths that no query took

@R.register("first_wins_rejected", R.ORACLE["first_wins"].replace("WHERE rn = 1 AND NOT EXISTS", "WHERE rn > 1 OR EXISTS"))
def q_first_wins_rejected(spark, sf):
    target, incoming = R._orders_split(spark, sf)
    _, rejected = ingest.insert_batches(target, incoming, batch=["o_custkey", "yr"], key=["o_custkey", "mo"], mode="first_wins", order=["o_orderdate", "o_orderkey"])
    return rejected.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@R.register("dead_letter_sink", f"SELECT DISTINCT CAST(user_id AS VARCHAR) AS value FROM ({R.ORACLE['dead_letter']})")
def q_dead_letter_sink(spark, sf):
    path = scratch_path(spark, "dead-letters")
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    dead = ingest.dead_letter(events, ["user_id"], ["ts", "event_id"], status="event_type", fail_value="error")
    ingest.write_dead_letters(dead, path, col="user_id")
    return spark.read.text(path)


def _saved(spark, df, name, **layout):
    db = tables.ensure_database(spark, "skyframe_scratch", location=scratch_path(spark, "db-scratch"))
    table = f"{db}.{name}_{uuid.uuid4().hex[:8]}"
    tables.write_table(df, table, path=scratch_path(spark, f"table-{name}"), **layout)
    return tables.read_table(spark, table)


@R.register("partitioned_table", R.WITH_DWD + f"\nSELECT {R.DWD_COLS} FROM dwd")
def q_partitioned_table(spark, sf):
    rows = R.dwd(spark, sf)
    saved = _saved(spark, rows, "dwd", partition_by=("district",), sort_within=("year_mon_day",))
    return saved.select(*rows.columns)


@R.register("bucketed_table", "SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey")
def q_bucketed_table(spark, sf):
    customers = _saved(spark, read_table(spark, sf, "customer").select("c_custkey", "c_name"), "customer", bucket_by=(8, ["c_custkey"]))
    orders = _saved(spark, read_table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "orders", bucket_by=(8, ["c_custkey"]))
    return customers.join(orders, "c_custkey")


@R.register("sorted_obs", R.WITH_DWD + "\nSELECT district, year_mon_day, count(*) AS n, true AS in_order FROM dwd GROUP BY district, year_mon_day")
def q_sorted_obs(spark, sf):
    # each (district, day) must come after the one before it, in one piece
    path = scratch_path(spark, "sorted")
    C.sort_obs(R.dwd(spark, sf)).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    groups = spark.read.parquet(path).groupBy("district", "year_mon_day").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("a"), F.max("place").alias("b"))
    before = F.lag("b").over(Window.orderBy(F.col("district").asc_nulls_last(), F.col("year_mon_day").asc_nulls_last()))  # districts x days
    return groups.withColumn("in_order", F.coalesce(before < F.col("a"), F.lit(True))).select("district", "year_mon_day", "n", "in_order")


_MARKS = ("\\N", "\\Nx", "\\N\\N", "", "  lead and trail ", None)


@R.register("staged_table", R.WITH_OBS + r"""
SELECT district, year_mon_day, week, max_t, min_t, ['\N', '\Nx', '\N\N', '', '  lead and trail ', NULL][l_linenumber % 6 + 1] AS weather, wind, aqi,
       CASE WHEN l_linenumber % 2 = 0 THEN '\N' || wind END AS aqi_type FROM obs""")
def q_staged_table(spark, sf):
    # staged as text, read back through the table that stage_job makes
    rows = R.ods(spark, sf)
    n = F.col("l_linenumber")
    rows = rows.withColumn("weather", F.element_at(F.array(*[F.lit(m) for m in _MARKS]), n % 6 + 1)).withColumn("aqi_type", F.when(n % 2 == 0, F.concat(F.lit("\\N"), "wind")))
    db = tables.ensure_database(spark, "skyframe_scratch", location=scratch_path(spark, "db-scratch"))
    name = stage_job(spark, rows, scratch_path(spark, "staged-ods"), f"{db}.ods_{uuid.uuid4().hex[:8]}")
    return spark.table(name).select(*ODS.fieldNames())


@R.register("staged_quarantine", """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
r AS (SELECT *, CASE k % 50 WHEN 0 THEN k || '^WEA' || c WHEN 1 THEN k || '^WEA' || c || '^WEAx' || cents ELSE k || '^WEA' || c || '^WEA' || cents END AS line,
             CASE WHEN k % 50 = 0 THEN 'arity' WHEN k % 50 = 1 THEN 'type' WHEN cents < 5000000 THEN 'cheap' END AS rule FROM o)
SELECT CASE WHEN rule IS NULL THEN k END AS o_orderkey, CASE WHEN rule IS NULL THEN c END AS o_custkey, CASE WHEN rule IS NULL THEN cents END AS cents,
       rule, CASE WHEN rule IS NOT NULL THEN line END AS line, CASE WHEN rule IS NOT NULL THEN count(*) OVER (PARTITION BY rule) END AS of_rule FROM r""")
def q_staged_quarantine(spark, sf):
    # orders staged with lines cut short and amounts that are no numbers; cheap orders break a rule
    path, k = scratch_path(spark, "staged-orders"), F.col("o_orderkey")
    rows = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    amount = F.when(k % 50 == 1, F.concat(F.lit("x"), F.col("cents").cast("string"))).when(k % 50 != 0, F.col("cents").cast("string"))
    rows.select(F.concat_ws("^WEA", k.cast("string"), F.col("o_custkey").cast("string"), amount)).write.text(path)
    got = quarantine.load_quarantined(spark, path, rows.schema, scratch_path(spark, "loaded-orders"), rules={"cheap": F.col("cents") >= 5_000_000})
    rejects = got.rejects.join(got.counts.withColumnRenamed("n", "of_rule"), "rule").select("rule", "line", "of_rule")
    return got.good.unionByName(rejects, allowMissingColumns=True)


@R.register("page_stream", R.ORACLE["page_ingest"].split("SELECT printf(")[0] + """
SELECT district, year_mon_day, max_t, min_t, wind, aqi, aqi_type FROM a WHERE accepted""")
def q_page_stream(spark, sf):
    # a micro-batch of pages as first fetched, then one of those fetched again
    pages, landing, target, state, rejected = R._fetched_pages(spark, sf), *(scratch_path(spark, n) for n in ("pages-landing", "pages-target", "pages-ckpt", "pages-rejected"))
    for wave in (1, 2):
        pages.filter(F.col("url").endswith(f"try={wave}")).write.mode("append").parquet(landing)
        stored, _ = ingest_pages_stream(spark, landing, target=target, rejected=rejected, checkpoint=state, areas=R._customer_areas(spark, sf))
    return stored.select("district", "year_mon_day", "max_t", "min_t", "wind", "aqi", "aqi_type")
