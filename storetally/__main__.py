"""`python -m storetally --input-path ... --output-path ...`"""

from __future__ import annotations

import argparse
import json

from storetally.plans.pipeline import LOADERS, build_flat, run_flat, run_pipeline, run_profile
from storetally.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="storetally", description="Retail sales analysis")
    parser.add_argument("--input-path", required=True, help="folder with fact chunks and master data")
    parser.add_argument("--output-path", required=True, help="folder for the results")
    parser.add_argument(
        "--job",
        choices=["star", "flatten", "flat", "profile"],
        default="star",
        help="analyse star tables, join them to a flat table, analyse a flat table, or profile star tables",
    )
    parser.add_argument("--layout", choices=sorted(LOADERS), default="chunks", help="how the star fact is stored")
    parser.add_argument("--window", default="1 month", help="length of the time windows")
    parser.add_argument("--cache", action="store_true", help="keep the star fact's needed columns in memory")
    parser.add_argument("--one-scan", action="store_true", help="total the star fact once, analyse the totals")
    parser.add_argument(
        "--shuffle-partitions",
        type=int,
        help="shuffle partitions before AQE merges small ones; about the shuffled bytes / 128 MB",
    )
    args = parser.parse_args(argv)

    sizing = {}
    if args.shuffle_partitions:
        sizing["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(args.shuffle_partitions)
    spark = build_session(**sizing)
    try:
        if args.job == "flatten":
            result = build_flat(spark, args.input_path, args.output_path)
        elif args.job == "profile":
            result = run_profile(spark, args.input_path, args.output_path)
        elif args.job == "flat":
            result = run_flat(spark, args.input_path, args.output_path, args.window)
        else:
            result = run_pipeline(
                spark, args.input_path, args.output_path, args.layout, args.window, args.cache, args.one_scan
            )
        print(json.dumps(result, indent=2, default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
