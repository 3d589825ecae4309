"""Command line: run one job, print its verdict, exit with its code.

    spark-submit telemill/__main__.py nightly --lake hdfs:///lake --landing jdbc:postgresql://host/db
"""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import datetime, timezone
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame  # noqa: E402

from telemill import contract  # noqa: E402
from telemill.plans import jobs  # noqa: E402
from telemill.plans.lake import Lake  # noqa: E402
from telemill.session import build_session, ship  # noqa: E402
from telemill.sources.cursors import CURSORS, parallel_scan, start_value  # noqa: E402
from telemill.sources.dumps import dump_files  # noqa: E402


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="telemill")
    parser.add_argument(
        "job",
        choices="nightly retention freshness dumps maintenance upkeep publish export".split(),
    )
    parser.add_argument("--lake", required=True, help="folder of the lake tables")
    parser.add_argument("--landing", help="JDBC url, or the folder of stored landing tables")
    parser.add_argument("--dumps", help="folder of the probe dump files")
    parser.add_argument("--target", help="folder for an export")
    parser.add_argument("--limit", type=int, help="most dump files to read")
    parser.add_argument("--order", choices=("oldest", "newest"), default="oldest")
    parser.add_argument("--partitions", type=int, default=32, help="connections of the nightly scan of a database")
    parser.add_argument("--tables", nargs="+", choices=tuple(contract.TABLES), default=tuple(contract.TABLES), help="tables to export")
    parser.add_argument("--days", type=int, help="age limit of retention, maintenance or upkeep")
    parser.add_argument("--max-age-hours", type=int, default=26)
    parser.add_argument("--strict", action="store_true", help="publish: new JDL keys fail the job")
    parser.add_argument(
        "--start", action="append", default=[], metavar="TABLE=VALUE", help="first-run cursor start"
    )
    return parser.parse_args(argv)


def landing_tables(lake: Lake, landing: str, starts: dict[str, str], partitions: int) -> dict[str, DataFrame]:
    if landing.startswith("jdbc:"):
        tables = {}
        for served in jobs.SERVED:
            cursor = CURSORS[served.landing]
            start = start_value(cursor, lake.cursor(served.lake), starts.get(served.landing))
            tables[served.landing] = parallel_scan(
                lake.spark, landing, served.landing, cursor.column, cursor.kind, start, partitions
            )
        return tables
    return {name: Lake(lake.spark, landing).read(name) for name in CURSORS}


def run(args: argparse.Namespace) -> int:
    spark = build_session(f"telemill-{args.job}")
    ship(spark)
    lake, now, run_id = Lake(spark, args.lake), datetime.now(timezone.utc), uuid.uuid4().hex
    days = {} if args.days is None else {"days": args.days}
    if args.job == "nightly":
        starts = dict(item.split("=", 1) for item in args.start)
        verdict = jobs.run_nightly(lake, landing_tables(lake, args.landing, starts, args.partitions), run_id, starts)
    elif args.job == "retention":
        verdict = jobs.run_retention(Lake(spark, args.landing), lake, now, **days)
    elif args.job == "freshness":
        verdict = jobs.check_freshness(lake, now, max_age_hours=args.max_age_hours)
    elif args.job == "dumps":
        verdict = jobs.run_dumps(lake, dump_files(spark, args.dumps), run_id, args.limit, args.order)
    elif args.job == "maintenance":
        verdict = jobs.run_maintenance(lake, now, **days)
    elif args.job == "upkeep":
        verdict = jobs.run_upkeep(lake, now, **days)
    elif args.job == "publish":
        verdict = jobs.publish_contract(lake, args.strict)[0]
    else:
        verdict = jobs.run_export(lake, args.target, now, args.tables)
    verdict.show(truncate=False)
    return jobs.exit_code(verdict) if "exit_code" in verdict.columns else 0


if __name__ == "__main__":
    sys.exit(run(arguments()))
