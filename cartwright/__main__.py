"""Command line: ``python -m cartwright <job> ...``.

  profile   --raw DIR | --tables DIR   --out PATH
  transform --raw DIR | --tables DIR   --out DIR  [--partition-by-month] [--buckets N]
  quality   --master PATH
  reports   --master PATH              --out DIR
  sql       --master PATH              --out DIR  [--sql DIR]
  all       --raw DIR | --tables DIR   --out DIR

With --raw, --file table=name (repeatable) names a table's file in the folder.
"""

from __future__ import annotations

import argparse
import json
import sys

from cartwright.plans import pipeline as PL
from cartwright.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cartwright")
    ap.add_argument("job", choices=["profile", "transform", "quality", "reports", "sql", "all"])
    ap.add_argument("--raw", help="directory with the raw CSV files")
    ap.add_argument("--file", action="append", default=[], metavar="TABLE=NAME",
                    help="file name of a source table in --raw")
    ap.add_argument("--sql", help="directory with report SQL files (default: the packaged ones)")
    ap.add_argument("--tables", help="directory with the parquet test tables")
    ap.add_argument("--master", help="master_orders parquet path")
    ap.add_argument("--out", help="output path or directory")
    ap.add_argument("--partition-by-month", action="store_true")
    ap.add_argument("--buckets", type=int, default=None,
                    help="bucket the master on order_id (same value for quality/reports)")
    ap.add_argument("--master-url", default=None, help="Spark master (default: spark-submit's)")
    args = ap.parse_args(argv)
    if wrong := [f for f in args.file if "=" not in f]:
        ap.error(f"--file wants TABLE=NAME, not {wrong[0]}")
    files = dict(f.split("=", 1) for f in args.file)

    spark = build_session(master=args.master_url)
    try:
        if args.job == "profile":
            PL.profile_job(PL.open_inputs(spark, args.raw, args.tables, files), args.out)
        elif args.job in ("transform", "all"):
            parts = ("purchase_year", "purchase_month") if args.partition_by_month else ()
            res = PL.transform_job(PL.open_inputs(spark, args.raw, args.tables, files), args.out, parts,
                                   args.buckets)
            print(json.dumps(res.__dict__))
            if args.job == "all":
                PL.quality_job(spark, res.master_path, args.buckets)
                print(json.dumps(PL.reports_job(spark, res.master_path, f"{args.out}/reports",
                                                args.buckets)))
        elif args.job == "quality":
            for r in PL.quality_job(spark, args.master, args.buckets).collect():
                print(json.dumps(r.asDict()))
        elif args.job == "sql":
            print(json.dumps(PL.sql_job(spark, args.master, args.out, args.sql, args.buckets)))
        elif args.job == "reports":
            print(json.dumps(PL.reports_job(spark, args.master, args.out, args.buckets)))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
