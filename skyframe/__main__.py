"""Command line for the batch jobs and dashboard views.

    python -m skyframe collect --pages PATH --table NAME [--mode atomic|first_wins]
    python -m skyframe merge --tables A B ... --table NAME [--tag 地区]
    python -m skyframe stage --source NAME --ods NAME --path PATH
    python -m skyframe clean --ods NAME --dwd NAME
    python -m skyframe deadletters --attempts NAME --out PATH [--status-col status] [--fail 403]
    python -m skyframe view --dwd NAME --view table|trend|map|pie|parallel|bar
                            [--place 朝阳区] [--period 2016-01] [--labels 最高温 天气]
                            [--out PATH] [--show N] [--any-place]

Tables are catalog names (optionally with a ``path`` for external tables);
``view`` writes its whole frame as Parquet to ``--out``; without it, it prints the
first rows and says so.  ``--place`` takes the offered places; ``--any-place`` lets
any stored district through.
The session comes from ``spark-submit``/environment settings; on a local
run the tuned local session is used.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    """The active session; else, when a master is configured (spark-submit,
    spark-defaults), a session on it with the submitted settings; else the
    tuned local session."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    submitted = ("PYSPARK_GATEWAY_PORT" in os.environ          # started by spark-submit
                 or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    if submitted:
        return SparkSession.builder.appName("skyframe").getOrCreate()
    from .session import build_session
    return build_session(master="local[*]")


def _view(spark, args):
    from .operators.query import check_place
    from .plans import dashboard as D
    dwd = spark.table(args.dwd)
    if not args.any_place:
        check_place(args.place)
    if args.view == "table":
        return D.data_table(dwd, args.place, args.period, args.labels)
    if args.view == "trend":
        return D.trend_panel(dwd, args.place, args.period)
    if args.view == "map":
        return D.map_panel(dwd, args.period)
    if args.view == "pie":
        return D.pie_panel(dwd, args.place, args.period)["shares"]
    if args.view == "parallel":
        return D.parallel_panel(dwd, args.place, args.period)["series"]
    return D.bar_panel(dwd, args.place, args.period)


def main(argv=None) -> int:
    """Parse the command line and run one job or view."""
    p = argparse.ArgumentParser(prog="skyframe")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("collect", help="landed pages -> observation table (append)")
    c.add_argument("--pages", required=True)
    c.add_argument("--format", default="parquet", choices=["parquet", "text"])
    c.add_argument("--table", required=True)
    c.add_argument("--path")
    c.add_argument("--mode", default="atomic", choices=["atomic", "first_wins"])
    c.add_argument("--rejected", help="folder for the rejected rows (Parquet)")
    c.add_argument("--buckets", type=int, help="bucket the store by (district, date) into N buckets")
    m = sub.add_parser("merge", help="tagged union of tables")
    m.add_argument("--tables", nargs="+", required=True)
    m.add_argument("--table", required=True)
    m.add_argument("--tag", default="地区")
    m.add_argument("--path")
    st = sub.add_parser("stage", help="source table -> staged delimited-text ODS table (full refresh)")
    st.add_argument("--source", required=True)
    st.add_argument("--ods", required=True)
    st.add_argument("--path", required=True)
    k = sub.add_parser("clean", help="ODS table -> cleaned DWD table")
    k.add_argument("--ods", required=True)
    k.add_argument("--dwd", required=True)
    k.add_argument("--path")
    dl = sub.add_parser("deadletters", help="append targets whose one retry failed too (or never came) to text")
    dl.add_argument("--attempts", required=True, help="table of fetch attempts (url, ts, status)")
    dl.add_argument("--out", required=True)
    dl.add_argument("--url-col", default="url")
    dl.add_argument("--ts-col", default="ts")
    dl.add_argument("--status-col", default="status")
    dl.add_argument("--fail", default="403")
    v = sub.add_parser("view", help="one dashboard view of the cleaned table")
    v.add_argument("--dwd", required=True)
    v.add_argument("--view", required=True, choices=["table", "trend", "map", "pie", "parallel", "bar"])
    v.add_argument("--place")
    v.add_argument("--period", default="")
    v.add_argument("--labels", nargs="*", default=["最高温", "最低温", "天气", "风向", "空气质量指数", "空气质量"])
    v.add_argument("--out")
    v.add_argument("--show", type=int, default=20)
    v.add_argument("--any-place", action="store_true")
    args = p.parse_args(argv)

    spark = _session()
    from .plans import jobs
    if args.cmd == "collect":
        from .sources.pages import read_pages
        rejected = jobs.collect_job(spark, read_pages(spark, args.pages, args.format), args.table,
                                    mode=args.mode, path=args.path, buckets=args.buckets)
        if args.rejected:
            rejected.write.mode("overwrite").parquet(args.rejected)
    elif args.cmd == "merge":
        jobs.merge_job(spark, args.tables, args.table, tag_col=args.tag, path=args.path)
    elif args.cmd == "stage":
        jobs.stage_job(spark, spark.table(args.source), args.path, args.ods)
    elif args.cmd == "clean":
        jobs.load_clean_job(spark, args.ods, args.dwd, path=args.path)
    elif args.cmd == "deadletters":
        from .operators.ingest import dead_letter, write_dead_letters
        attempts = spark.table(args.attempts).withColumn(args.status_col, spark.table(args.attempts)[args.status_col].cast("string"))
        dead = dead_letter(attempts, [args.url_col], [args.ts_col], status=args.status_col, fail_value=args.fail)
        write_dead_letters(dead, args.out, col=args.url_col)
    else:
        df = _view(spark, args)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            print(f"at most {args.show} rows; --out writes all of them")
            df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
