"""Command line: ``python -m tallybeat.jobs <step> ...`` or the same file in spark-submit."""

from __future__ import annotations

import argparse

from tallybeat.plans import lakehouse
from tallybeat.plans.ingest import ingest, outcome
from tallybeat.session import build_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tallybeat")
    steps = parser.add_subparsers(dest="step", required=True)

    step = steps.add_parser("ingest", help="land new listen files")
    step.add_argument("--source", required=True)
    step.add_argument("--bronze", required=True)
    step.add_argument("--date", required=True, help="yyyy-MM-dd")

    step = steps.add_parser("generate", help="write seeded reference data")
    step.add_argument("--listens", required=True, help="folder with listen files to take ids from")
    step.add_argument("--date", help="take ids from this ingest date of the folder only")
    step.add_argument("--bronze", required=True)

    step = steps.add_parser("silver", help="conform bronze and count streams")
    step.add_argument("--bronze", required=True)
    step.add_argument("--date", required=True)

    steps.add_parser("gold", help="build the star schema")
    steps.add_parser("report", help="print counts and KPIs")

    step = steps.add_parser("inventory", help="files and bytes per bronze folder")
    step.add_argument("--bronze", required=True)

    steps.add_parser("drop", help="drop all tables")
    for step in steps.choices.values():
        step.add_argument("--silver", default="silver", help="namespace of the conformed tables")
        step.add_argument("--gold", default="gold", help="namespace of the star schema")
        step.add_argument("--log", help="table that records each write")
    args = parser.parse_args(arguments)

    spark = build_session(f"tallybeat-{args.step}")
    if args.step == "ingest":
        entries = ingest(spark, args.source, f"{args.bronze}/{lakehouse.LISTENS}", args.date)
        outcome(entries).show()
    elif args.step == "generate":
        listens = f"{args.listens}/ingested_date={args.date}" if args.date else args.listens
        lakehouse.generate_bronze(spark, listens, args.bronze)
    elif args.step == "inventory":
        lakehouse.inventory(spark, args.bronze).show(lakehouse.EVERY, truncate=False)
    else:
        house = lakehouse.Lakehouse(spark, args.silver, args.gold, args.log)
        if args.step == "silver":
            print(house.build_silver(args.bronze, args.date))
        elif args.step == "gold":
            print(house.build_gold())
        elif args.step == "drop":
            print(house.drop())
        else:
            lakehouse.show(house.report())


if __name__ == "__main__":
    main()
