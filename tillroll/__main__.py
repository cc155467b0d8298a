"""Command line of the batch job, for spark-submit or ``python -m tillroll``."""

from __future__ import annotations

import argparse
import os
from functools import partial

from pyspark.sql import SparkSession, functions as F

from tillroll import sizing
from tillroll.job import run
from tillroll.schema import CUSTOMER_TYPES, LOYALTY, MEASURE_PRECISION, MEASURE_SCALE
from tillroll.sinks import FileSet, write_files, write_jdbc
from tillroll.sources import discover


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillroll", description="Publish the retail sales reports.")
    parser.add_argument("--input", required=True, help="folder of the delivered files")
    sink = parser.add_mutually_exclusive_group(required=True)
    sink.add_argument("--output", help="folder that gets the reports as Parquet tables, one set per run")
    sink.add_argument("--jdbc-url", help="database that gets one table per report")
    parser.add_argument(
        "--replace-each",
        action="store_true",
        help="write each report of --output in place, instead of all as one set",
    )
    parser.add_argument("--jdbc-driver", help="driver class")
    parser.add_argument("--jdbc-user")
    parser.add_argument(
        "--jdbc-password-env", help="name of the environment variable that holds the password"
    )
    parser.add_argument(
        "--unknown-customers",
        choices=CUSTOMER_TYPES,
        default=LOYALTY,
        help="customer type of rows whose collector key is missing or zero",
    )
    parser.add_argument(
        "--headers-by-folder",
        action="store_true",
        help="look up one header per folder instead of one per file",
    )
    parser.add_argument("--precision", type=int, default=MEASURE_PRECISION, help="digits of a measure")
    parser.add_argument("--scale", type=int, default=MEASURE_SCALE, help="decimals of a measure")
    return parser.parse_args(arguments)


def jdbc_options(args: argparse.Namespace) -> dict[str, str]:
    given = {
        "url": args.jdbc_url,
        "driver": args.jdbc_driver,
        "user": args.jdbc_user,
        "password": os.environ[args.jdbc_password_env] if args.jdbc_password_env else None,
    }
    return {name: value for name, value in given.items() if value is not None}


def main() -> None:
    args = parse()
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    if args.output:
        write = partial(write_files, folder=args.output) if args.replace_each else FileSet(spark, args.output)
    else:
        write = partial(write_jdbc, options=jdbc_options(args))
    try:
        delivered = discover(spark, args.input).agg(F.sum("bytes").alias("bytes")).first()
        sizing.apply(spark, delivered["bytes"] or 0)
        run(spark, args.input, write, args.unknown_customers, args.headers_by_folder, args.precision, args.scale)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
