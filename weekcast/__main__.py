"""Command line: list or run registered queries.

    python -m weekcast list
    python -m weekcast run forecast_best --sf /root/testdata/sf0.01 [--out PATH] [--show 20]

``--out`` writes the result as Parquet (overwrite); otherwise ``--show`` rows
are printed.  The session is local unless ``--master`` names another one.
"""

from __future__ import annotations

import argparse
import sys

from weekcast.queries import QUERIES


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="weekcast")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query", choices=sorted(QUERIES))
    run.add_argument("--sf", required=True, help="folder with <table>.parquet files")
    run.add_argument("--out", help="write the result here as Parquet")
    run.add_argument("--show", type=int, default=20)
    run.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)
    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    from pyspark.sql import SparkSession

    from weekcast.session import shared_dir, ship_package
    spark = (SparkSession.builder.master(args.master).appName(f"weekcast-{args.query}")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    shared_dir(spark)
    ship_package(spark)
    df = QUERIES[args.query](spark, args.sf)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
