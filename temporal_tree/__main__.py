"""The full batch for spark-submit: raw tables in, star schema out.

    spark-submit --conf spark.checkpoint.dir=... --py-files temporal_tree.zip \\
        temporal_tree/__main__.py --edges PATH --partners PATH --mappings PATH --out PATH

Without paths the raw tables are read from the catalog; with --database instead of --out the star
goes to catalog tables. A database as source or target takes connection options, which belong in
code: see `load_raw` and `write_star`. The reports of all checks are logged before the star is
written, unless --no-validate is given. With --resume a batch that was lost goes on where it was.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import fields
from datetime import datetime

from pyspark.sql import SparkSession

from temporal_tree import PipelineOptions, load_raw, run, write_star
from temporal_tree.schemas import RAW_TABLES

log = logging.getLogger("temporal_tree")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="temporal_tree")
    for source in ("edges", "partners", "mappings"):
        parser.add_argument(f"--{source}", help="parquet path of this raw table")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--out", help="folder for parquet tables")
    target.add_argument("--database", help="catalog database for tables")
    parser.add_argument("--max-depth", type=int, default=12)
    parser.add_argument("--half-open", action="store_true")
    parser.add_argument("--keep-unmapped", action="store_true")
    parser.add_argument("--unmapped-flags", choices=("partner", "always"), default="partner")
    parser.add_argument("--succession-key", choices=("child", "manager"), default="child")
    parser.add_argument("--one-row-per-account", action="store_true")
    parser.add_argument("--partition-by-account", action="store_true")
    parser.add_argument("--collapse", action=argparse.BooleanOptionalAction, default=True)
    parser.add_argument("--validate", action=argparse.BooleanOptionalAction, default=True)
    parser.add_argument("--closure-method", choices=("doubling", "cte"), default="doubling")
    parser.add_argument("--persist", choices=("table", "cache", "none"), default="table")
    parser.add_argument("--load-ts", type=datetime.fromisoformat, help="value of created_at")
    parser.add_argument("--resume", help="shared folder whose finished tables are taken over")
    for size in ("cell-rows", "hot-account-rows", "rows-per-task"):
        default = getattr(PipelineOptions, size.replace("-", "_"))
        parser.add_argument(f"--{size}", type=int, default=default)
    args = parser.parse_args(argv)
    if any((args.edges, args.partners, args.mappings)) and not all(
        (args.edges, args.partners, args.mappings)
    ):
        parser.error("give all three raw paths or none")
    return args


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = (
        SparkSession.builder.appName("temporal_tree")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    files = dict(zip(RAW_TABLES, (args.edges, args.partners, args.mappings)))
    options = {f.name: getattr(args, f.name) for f in fields(PipelineOptions)}
    with run(
        load_raw(spark, paths=files if args.edges else None),
        PipelineOptions(**options),
        resume=args.resume,
    ) as result:
        for name, report in result.checks.items():
            for row in report.collect():  # some metrics per report
                log.info("%s %s %s", name, row["metric"], row["value"])
        write_star(result.star.tables(), path=args.out, database=args.database)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
