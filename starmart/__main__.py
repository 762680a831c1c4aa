"""Command line of the mart jobs, one job per call so that any scheduler can order them.

    python -m starmart daily --inputs s3a://raw --staging s3a://staging --warehouse s3a://mart
    spark-submit --py-files starmart.zip starmart/__main__.py dim_customer --as-of 2025-01-31 --inputs ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from starmart.config import DEFAULT_CALENDAR, DEFAULT_FLOOR_DATE, Calendar, MartConfig
from starmart.plans import daily
from starmart.plans.dimensions import SPECS
from starmart.session import get_or_create_spark_session

Job = Callable[[SparkSession, MartConfig, dt.date], None]


def _dimension_job(table: str) -> Job:
    return lambda spark, cfg, as_of: daily.refresh_dimension(cfg, daily.raw_sources(spark, cfg), SPECS[table], as_of)


JOBS: dict[str, Job] = {
    "daily": daily.run_daily,
    "migrations": lambda spark, cfg, as_of: daily.migrate(spark, cfg),
    "stg_orders": lambda spark, cfg, as_of: daily.refresh_orders(cfg, daily.raw_sources(spark, cfg)),
    "stg_order_items": lambda spark, cfg, as_of: daily.refresh_order_items(cfg, daily.raw_sources(spark, cfg)),
    **{table: _dimension_job(table) for table in SPECS},
    "fact_order_items": daily.load_order_items,
    "fact_order_summary": daily.load_order_summary,
}


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starmart", description="Run a job of the retail mart.")
    parser.add_argument("job", choices=JOBS)
    for location in ("inputs", "staging", "warehouse"):
        parser.add_argument(f"--{location}", required=True, help="folder URI")
    parser.add_argument("--namespace", default=MartConfig.namespace)
    parser.add_argument("--table-format", default=MartConfig.table_format)
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today(), help="processing date")
    parser.add_argument("--floor-date", type=dt.date.fromisoformat, default=DEFAULT_FLOOR_DATE)
    parser.add_argument("--calendar-start", type=dt.date.fromisoformat, default=DEFAULT_CALENDAR.start)
    parser.add_argument("--calendar-end", type=dt.date.fromisoformat, default=DEFAULT_CALENDAR.end)
    parser.add_argument("--relaxed", action="store_true", help="keep rows that break the table contracts")
    parser.add_argument("--quarantine", action="store_true", help="set fact rows that break the table contracts aside")
    parser.add_argument("--unknown-members", action="store_true", help="unknown members and zeros instead of NULLs")
    parser.add_argument("--contiguous", action="store_true", help="versions end where the next one begins")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s - %(name)s - %(levelname)s - %(message)s")
    cfg = MartConfig(
        inputs=args.inputs,
        staging=args.staging,
        warehouse=args.warehouse,
        namespace=args.namespace,
        table_format=args.table_format,
        calendar=Calendar(args.calendar_start, args.calendar_end),
        floor_date=args.floor_date,
        strict=not args.relaxed,
        quarantine=args.quarantine,
        unknown_members=args.unknown_members,
        contiguous_validity=args.contiguous,
    )
    JOBS[args.job](get_or_create_spark_session(f"starmart-{args.job}"), cfg, args.as_of)


if __name__ == "__main__":
    main()
