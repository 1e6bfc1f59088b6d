"""Command line: `ingest`, `refine` and `marts`.

Run with spark-submit. Database credentials come from the environment (see `sources.jdbc`).
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from zonalake.operators.staging import cast_known
from zonalake.plans import gold, layers
from zonalake.schemas import AIR_SOURCE, SILVER, SILVER_AIR, SILVER_TRAFFIC
from zonalake.session import build_session
from zonalake.sinks import create_silver_view, is_view, register_table, write_jdbc, write_jdbc_staged
from zonalake.sources import read_jdbc, read_table, read_traffic_csv

log = logging.getLogger("zonalake")

PREVIEW_ROWS = 20


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="zonalake", description=__doc__)
    top.add_argument("--time_zone", default="UTC", help="zone in which the hour of a time is taken")
    steps = top.add_subparsers(dest="step", required=True)

    step = steps.add_parser("ingest", help="sources into the raw layer")
    step.add_argument("--traffic_input", help="CSV path of the traffic counts")
    step.add_argument("--output_traffic")
    step.add_argument("--jdbc_url", help="database of the air measurements")
    step.add_argument("--jdbc_table")
    step.add_argument("--jdbc_driver", default="org.mariadb.jdbc.Driver")
    step.add_argument("--partition_column", help="column to split the read by")
    step.add_argument("--equal_width", action="store_true", help="split it by width, not by rows")
    step.add_argument("--lower_bound")
    step.add_argument("--upper_bound")
    step.add_argument("--partitions", type=int)
    step.add_argument("--output_air")
    step.add_argument("--ingest_date", type=date.fromisoformat, default=None)

    step = steps.add_parser("refine", help="raw layer into the silver layer")
    step.add_argument("--air_input", required=True)
    step.add_argument("--traffic_input", required=True)
    step.add_argument("--silver_output", required=True)
    step.add_argument("--ingest_date", type=date.fromisoformat, default=None)
    step.add_argument("--silver_table", help="catalog name; sides get the suffixes _air, _traffic")
    step.add_argument(
        "--drop_duplicates", action="store_true", help="keep rows ingested again once"
    )
    step.add_argument(
        "--report_rules", action="store_true", help="count the rows that fail each rule"
    )
    step.add_argument(
        "--quarantine", action="store_true", help="keep rejected rows, with the rules they fail"
    )
    step.add_argument(
        "--join_rows", action="store_true", help="store the row-level join instead of a view"
    )

    step = steps.add_parser("marts", help="silver layer into the gold marts")
    source = step.add_mutually_exclusive_group(required=True)
    source.add_argument("--silver_input", help="folder that refine wrote")
    source.add_argument("--silver_table", help="catalog name given to refine")
    step.add_argument("--gold_output", required=True)
    step.add_argument(
        "--quarantine", action="store_true", help="the folder was refined with --quarantine"
    )
    step.add_argument("--ingest_date", type=date.fromisoformat, default=None)
    step.add_argument("--jdbc_url", help="database that gets the marts as tables too")
    step.add_argument("--jdbc_staged", action="store_true", help="replace their rows in one transaction")
    step.add_argument("--jdbc_driver", default="org.mariadb.jdbc.Driver")
    return top


def _need(args: argparse.Namespace, given: str, *others: str) -> None:
    missing = [name for name in others if not getattr(args, name)]
    if getattr(args, given) and missing:
        raise ValueError(f"--{given} needs " + ", ".join(f"--{name}" for name in missing))


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    _need(args, "traffic_input", "output_traffic")
    _need(args, "jdbc_url", "jdbc_table", "output_air")
    day = args.ingest_date or date.today()
    rows = {}
    if args.traffic_input:
        traffic = read_traffic_csv(spark, args.traffic_input)
        rows["traffic"] = layers.ingest(traffic, args.output_traffic, day)
    if args.jdbc_url:
        air = read_jdbc(
            spark,
            args.jdbc_url,
            args.jdbc_table,
            driver=args.jdbc_driver,
            partition_column=args.partition_column,
            lower_bound=args.lower_bound,
            upper_bound=args.upper_bound,
            partitions=args.partitions,
            balanced=not args.equal_width,
        )
        rows["air"] = layers.ingest(cast_known(air, AIR_SOURCE), args.output_air, day)
    return rows


def run_refine(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    folder = args.silver_output
    if args.quarantine:
        if args.drop_duplicates or args.report_rules or args.join_rows or args.silver_table:
            raise ValueError("--quarantine writes the two sides only")
        return layers.refine_with_quarantine(
            spark, args.air_input, args.traffic_input, folder, args.ingest_date
        )
    rows = layers.refine(
        spark,
        args.air_input,
        args.traffic_input,
        folder,
        args.ingest_date,
        drop_duplicates=args.drop_duplicates,
        report=args.report_rules,
    )
    if args.join_rows:
        rows["joined"] = layers.join_silver(spark, folder)
    name = args.silver_table
    if name:
        register_table(spark, f"{name}_air", f"{folder}/air", SILVER_AIR)
        register_table(spark, f"{name}_traffic", f"{folder}/traffic", SILVER_TRAFFIC)
        if args.join_rows:
            register_table(spark, name, f"{folder}/joined", SILVER)
        else:
            create_silver_view(spark, name, f"{name}_air", f"{name}_traffic")
    return rows


def run_marts(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Marts from a folder, from the view that refine made, or from a joined table.

    Folder and view give the two sides, which are pre-aggregated by date: with a date only that
    date is read and replaced, and the marts cover all dates. A joined table is always read whole.
    """
    name, day = args.silver_table, args.ingest_date
    if name and not is_view(spark, name):
        if day:
            raise ValueError("--ingest_date needs --silver_input or the view that refine made")
        cells = layers.settled_silver_cells(read_table(spark, name))
    else:
        if name:
            sides = [read_table(spark, f"{name}_{side}", day) for side in ("air", "traffic")]
        else:
            sides = layers.silver_sides(spark, args.silver_input, day, args.quarantine)
        layers.refresh_cells(*sides, args.gold_output, day)
        cells = layers.stored_cells(spark, args.gold_output)
    log.info("mean traffic per hour: %s", gold.hourly_traffic(cells).orderBy("hour").collect())
    rows = layers.write_marts(layers.marts_of_cells(cells), args.gold_output)
    for mart_name, mart in layers.read_marts(spark, args.gold_output).items():
        ordered = gold.in_order(mart_name, mart)
        log.info("%s: first rows %s", mart_name, ordered.limit(PREVIEW_ROWS).collect())
        if args.jdbc_url:
            write = write_jdbc_staged if args.jdbc_staged else write_jdbc
            write(ordered, args.jdbc_url, mart_name, driver=args.jdbc_driver)
    return rows


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> dict[str, int]:
    """Run one step on a given session and return the rows written per table."""
    args = parser().parse_args(argv)
    steps = {"ingest": run_ingest, "refine": run_refine, "marts": run_marts}
    rows = steps[args.step](spark, args)
    for table, count in rows.items():
        log.info("%s: %s rows written to %s", args.step, count, table)
    return rows


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parser().parse_args(argv)
    spark = build_session(f"zonalake-{args.step}", args.time_zone)
    try:
        run(spark, argv)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
