"""Command line of the jobs.

    spark-submit ... walkshed preprocess rail SOURCE TARGET
    spark-submit ... walkshed preprocess bus SOURCE TARGET --only-given-months
    spark-submit ... walkshed land PAGES TARGET --columns JSON
    spark-submit ... walkshed status PAGES --columns JSON
    spark-submit ... walkshed sizes LANDED
    spark-submit ... walkshed report TARGET --rail HOURLY --bus HOURLY --stations CSV --stops CSV
"""

from __future__ import annotations

import argparse
import json

from walkshed import jobs
from walkshed.schema import BUS, RAIL
from walkshed.session import build_session
from walkshed.sources import pages


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="walkshed")
    commands = parser.add_subparsers(dest="command", required=True)
    pre = commands.add_parser("preprocess", help="raw monthly CSV to the hourly Parquet table")
    pre.add_argument("mode", choices=[RAIL.name, BUS.name])
    pre.add_argument("source")
    pre.add_argument("target")
    pre.add_argument("--one-header-per", choices=["file", "folder"], default="file")
    pre.add_argument("--only-given-months", action="store_true")
    rep = commands.add_parser("report", help="hourly tables and coordinates to result tables")
    rep.add_argument("target")
    rep.add_argument("--rail", required=True, help="hourly rail table")
    rep.add_argument("--bus", required=True, help="hourly bus table")
    rep.add_argument("--stations", required=True, help="station coordinates")
    rep.add_argument("--stops", required=True, help="stop coordinates")
    rep.add_argument("--kept", help="folder of sums kept by month; only changed months are read")
    rep.add_argument("--first-ym", type=int)
    rep.add_argument("--last-ym", type=int)
    lan = commands.add_parser("land", help="landed pages to monthly CSV; prints the status of every month")
    sta = commands.add_parser("status", help="status of every month of landed pages")
    for command in (lan, sta):
        command.add_argument("pages")
        command.add_argument("--columns", required=True, help='JSON: {"service": ["column", ...]}')
    lan.add_argument("target")
    siz = commands.add_parser("sizes", help="files and megabytes per landed month")
    siz.add_argument("landed")
    args = parser.parse_args(argv)

    spark = build_session(f"walkshed {args.command}")
    if args.command == "preprocess":
        spec = {RAIL.name: RAIL, BUS.name: BUS}[args.mode]
        print(jobs.preprocess(spark, args.source, args.target, spec, args.one_header_per, args.only_given_months))
    elif args.command == "land":
        pages.land(pages.scan_pages(spark, args.pages), args.target, json.loads(args.columns)).show(1000, False)
    elif args.command == "status":
        pages.month_status(pages.scan_pages(spark, args.pages), json.loads(args.columns)).show(1000, False)
    elif args.command == "sizes":
        pages.reconciled(spark, args.landed).orderBy("dataset", "ym").show(1000, False)
    elif args.kept:
        if args.first_ym or args.last_ym:
            parser.error("--kept goes with all months")
        with jobs.load_kept_study(spark, args.rail, args.bus, args.stations, args.stops, args.kept) as study:
            jobs.write_report(study, args.target)
    else:
        with jobs.load_study(
            spark, args.rail, args.bus, args.stations, args.stops, first_ym=args.first_ym, last_ym=args.last_ym
        ) as study:
            jobs.write_report(study, args.target)


if __name__ == "__main__":
    main()
