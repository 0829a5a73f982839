"""Run the daily batch: `spark-submit daily_run.py --raw <csv> --out <folder>`.

The answers, reports and tables are stored below `--out`; the short ones are printed too.
"""

import argparse
import json
from datetime import datetime
from functools import cache

from pyspark.sql import SparkSession

from claimloom.functions.rules import AMOUNT_RANGE, ROW_COUNT_RANGE
from claimloom.operators.load import jdbc_rows, jdbc_sink
from claimloom.plans.run import RunResult, run
from claimloom.plans.sizing import PARTITION_BYTES
from claimloom.sources import files, jdbc

PRINTED_ROWS = 20
WAREHOUSES = {"postgres": jdbc.postgres_options, "snowflake": jdbc.snowflake_options}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True, help="CSV with raw claims")
    parser.add_argument("--out", required=True, help="folder for the tables and reports of this run")
    parser.add_argument("--least-rows", type=int, default=ROW_COUNT_RANGE[0], help="smallest batch accepted")
    parser.add_argument("--most-rows", type=int, default=ROW_COUNT_RANGE[1], help="largest batch accepted")
    parser.add_argument("--least-amount", type=float, default=AMOUNT_RANGE[0], help="smallest amount accepted")
    parser.add_argument("--most-amount", type=float, default=AMOUNT_RANGE[1], help="largest amount accepted")
    parser.add_argument("--resume", action="store_true", help="take up a run that broke off in the same folder")
    parser.add_argument("--partition-bytes", type=int, default=PARTITION_BYTES, help="input per shuffle partition")
    parser.add_argument("--date", type=datetime.fromisoformat, help="run date, today by default")
    parser.add_argument("--report-only", action="store_true", help="go on when a quality check failed")
    parser.add_argument("--warehouse", choices=WAREHOUSES, help="also load the tables over JDBC")
    parser.add_argument("--connections", type=int, help="open connections while loading")
    parser.add_argument("--batch-rows", type=int, help="rows per insert")
    parser.add_argument("--single-line", action="store_true", help="take each line for a record; line breaks inside fields are corrupt then")
    parser.add_argument("--config", help="JSON file with the `database` or `snowflake` section")
    return parser.parse_args(argv)


def _connection(args: argparse.Namespace) -> dict[str, str] | None:
    if args.warehouse is None:
        return None
    with open(args.config, encoding="utf-8") as file:
        options = WAREHOUSES[args.warehouse](json.load(file))
    given = {"numPartitions": args.connections, "batchsize": args.batch_rows}
    return options | {name: str(value) for name, value in given.items() if value}


def main(argv: list[str] | None = None) -> RunResult:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("claims").getOrCreate()
    if not files.has_data(spark, args.raw):
        raise FileNotFoundError(f"no raw claims at {args.raw}")
    connection = _connection(args)
    parsed = cache(lambda: files.csv_claims(spark, args.raw, not args.single_line))
    result = run(
        spark,
        lambda: parsed().claims,
        args.out,
        run_date=args.date.date() if args.date else None,
        strict=not args.report_only,
        primary=jdbc_sink(connection) if connection else None,
        primary_rows=jdbc_rows(spark, connection) if connection else None,
        corrupt=lambda: parsed().corrupt,
        resume=args.resume,
        source=f"{args.single_line} {files.fingerprint(spark, args.raw)}",
        amount_range=(args.least_amount, args.most_amount),
        row_count_range=(args.least_rows, args.most_rows),
        partition_bytes=args.partition_bytes,
    )
    for title, frame in {"Quality": result.quality, "Load": result.load_report, "Audit": result.audit, **result.answers}.items():
        print(title)
        frame.show(PRINTED_ROWS, truncate=False)
    print(f"All rows are stored below {args.out}")
    return result


if __name__ == "__main__":
    failed = main().load_report.where("NOT ok").count()
    raise SystemExit(1 if failed else 0)
