"""Run a job with spark-submit:

    spark-submit devicepulse/plans/cli.py drop-duplicates --root R --source S [--fmt csv]
    spark-submit devicepulse/plans/cli.py preprocess      --root R
    spark-submit devicepulse/plans/cli.py features        --root R
    spark-submit devicepulse/plans/cli.py train           --root R
    spark-submit devicepulse/plans/cli.py inference       --root R [--source S] [--nrows N]
    spark-submit devicepulse/plans/cli.py new-days        --root R --source S --part P

Memory and other session settings are spark-submit's to give.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from devicepulse.plans import jobs
from devicepulse.sources import load_manifest, read_table
from devicepulse.spec import TelemetrySpec


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    defaults = TelemetrySpec()
    parser = argparse.ArgumentParser(description="Device telemetry jobs")
    parser.add_argument(
        "job", choices=["drop-duplicates", "preprocess", "features", "train", "inference", "new-days"]
    )
    parser.add_argument("--root", required=True, help="folder for tables and artefacts")
    parser.add_argument("--source", help="input of drop-duplicates, inference and new-days")
    parser.add_argument("--part", help="new-days: name of the part that the new days are")
    parser.add_argument("--fmt", default="csv", help="format of the source")
    parser.add_argument("--schema", help="manifest of the source; types are inferred without one")
    parser.add_argument("--table-fmt", default="parquet", help="format of the stage tables")
    parser.add_argument("--buckets", type=int, help="lay stage tables out by device in so many parts")
    parser.add_argument("--ids", default=",".join(defaults.id_cols))
    parser.add_argument("--date", default=defaults.date_col)
    parser.add_argument("--target", default=defaults.target_col)
    parser.add_argument("--num-lags", type=int, default=defaults.num_lags)
    parser.add_argument("--null-cutoff", type=float, default=defaults.null_cutoff)
    parser.add_argument("--holdout", type=float, default=defaults.holdout_fraction)
    parser.add_argument("--seed", type=int, default=defaults.seed)
    parser.add_argument("--nrows", type=int, help="inference: only the first rows in key order")
    parser.add_argument("--number-cycles", action="store_true")
    parser.add_argument("--mostly-unique", action="store_true", help="few repeated device-days")
    parser.add_argument("--mode", help="write mode of the job's tables")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"devicepulse {args.job}").getOrCreate()
    spec = TelemetrySpec(
        id_cols=tuple(args.ids.split(",")),
        date_col=args.date,
        target_col=args.target,
        num_lags=args.num_lags,
        null_cutoff=args.null_cutoff,
        holdout_fraction=args.holdout,
        seed=args.seed,
    )
    layout = jobs.Layout(args.root, args.table_fmt, args.buckets)
    schema = load_manifest(spark, args.schema) if args.schema else None
    mode = {"mode": args.mode} if args.mode else {}
    if args.job == "drop-duplicates":
        if not args.source:
            raise SystemExit("drop-duplicates needs --source")
        jobs.drop_duplicates_job(
            spark, args.source, layout, spec, args.fmt, schema, mostly_unique=args.mostly_unique, **mode
        )
    elif args.job == "preprocess":
        jobs.preprocess_job(spark, layout, spec, args.number_cycles, **mode)
    elif args.job == "features":
        jobs.feature_job(spark, layout, spec, **mode)
    elif args.job == "train":
        jobs.train_job(spark, layout, spec)
    elif args.job == "new-days":
        if not args.source or not args.part:
            raise SystemExit("new-days needs --source and --part")
        rows = read_table(spark, args.source, args.fmt, schema)
        jobs.new_days_job(spark, layout, spec, rows, args.part, **mode)
    else:
        jobs.inference_job(
            spark, layout, spec, args.source, args.fmt, schema, nrows=args.nrows, **mode
        )


if __name__ == "__main__":
    main()
