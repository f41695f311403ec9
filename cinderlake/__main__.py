"""The jobs as commands: ``spark-submit`` or ``python -m cinderlake COMMAND ...``."""

from __future__ import annotations

import argparse

from cinderlake.plans import marts
from cinderlake.plans.growth import DRAWN_ROWS, grow_snapshot
from cinderlake.plans.medallion import load_latest
from cinderlake.session import cluster_session
from cinderlake.sources.warehouse import Warehouse

MARTS = {
    "weekdays": marts.incidents_by_weekday,
    "months": marts.average_alarms_by_month,
    "quarters": marts.property_loss_by_quarter,
    "years": marts.response_by_year,
    "weekends": marts.fatality_rate_by_weekend,
    "top-days": marts.top_days_by_alarms,
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cinderlake")
    commands = parser.add_subparsers(dest="command", required=True)
    reset = commands.add_parser("reset", help="empty all tables and fill the calendar")
    reset.add_argument("warehouse")
    load = commands.add_parser("load", help="load the latest snapshot of a folder")
    load.add_argument("warehouse")
    load.add_argument("snapshots")
    load.add_argument("--load-id")
    load.add_argument("--multi-line", action="store_true")
    load.add_argument("--most-rejects", type=int, help="go on at up to so many bad lines")
    grow = commands.add_parser("grow", help="write the next snapshot, with synthetic incidents")
    grow.add_argument("snapshots")
    grow.add_argument("--rows", type=int, default=DRAWN_ROWS)
    grow.add_argument("--seed", type=int, default=0)
    grow.add_argument("--distinct-keys", action="store_true", help="draw keys without collisions")
    mart = commands.add_parser("mart", help="show an analytical query")
    mart.add_argument("warehouse")
    mart.add_argument("name", choices=MARTS)
    mart.add_argument("--by-day", action="store_true", help="match days, not midnights")
    given = parser.parse_args(arguments)

    spark = cluster_session(f"cinderlake {given.command}")
    if given.command == "reset":
        Warehouse(spark, given.warehouse).reset()
    elif given.command == "load":
        warehouse = Warehouse(spark, given.warehouse)
        gained = load_latest(
            warehouse, given.snapshots, given.load_id, most_rejects=given.most_rejects,
            multi_line=given.multi_line,
        )
        for table, rows in gained.items():
            print(f"{table}: {rows} rows")
    elif given.command == "grow":
        name = grow_snapshot(
            spark, given.snapshots, given.rows, seed=given.seed, distinct_keys=given.distinct_keys
        )
        print(name)
    else:
        warehouse = Warehouse(spark, given.warehouse)
        fact = warehouse.read("fact_fire_department_injuries")
        calendar = warehouse.read("dim_date")
        result = MARTS[given.name](fact, calendar=calendar, by_day=given.by_day)
        # A mart has no more rows than the calendar has years.
        result.show(result.count(), False)


if __name__ == "__main__":
    main()
