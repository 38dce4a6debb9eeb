"""Refresh the lake and print its checks and main queries.

    spark-submit … -m medalake --location /data/oltp --root /data/lake
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from medalake.plans import catalogue, run
from medalake.session import submitted_session
from medalake.sources.jdbc import RangeSplit


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="medalake", description=__doc__.splitlines()[0])
    p.add_argument("--mode", choices=("parquet", "jdbc"), default="parquet")
    p.add_argument("--location", required=True, help="folder of Parquet tables, or JDBC URL")
    p.add_argument("--property", action="append", default=[], metavar="NAME=VALUE",
                   help="JDBC connection property, such as driver or user")
    p.add_argument("--split", action="append", default=[], metavar="TABLE:COLUMN:LOW:HIGH:PARTS",
                   help="ranges in which a JDBC table is read")
    p.add_argument("--root", required=True, help="folder of the lake")
    p.add_argument("--changes", help="Parquet table of segment changes (pasajero_id, fecha_cambio)")
    p.add_argument("--since", type=date.fromisoformat, default=date(2025, 5, 1))
    return p.parse_args(argv)


def jdbc_options(options: argparse.Namespace) -> tuple[dict[str, RangeSplit], dict[str, str]]:
    """Splits by table and connection properties; both empty for Parquet."""
    splits = {}
    for text in options.split:
        table, column, low, high, parts = text.split(":")
        splits[table] = RangeSplit(column, low, high, int(parts))
    return splits, dict(p.split("=", 1) for p in options.property)


def main(argv: list[str] | None = None) -> None:
    options = parse(argv)
    spark = submitted_session()
    changes = None
    if options.changes:
        def changes(_silver):
            return spark.read.parquet(options.changes)

    splits, properties = jdbc_options(options)
    source = run.open_source(spark, options.mode, options.location, splits, **properties)
    star = run.run(spark, source, options.root, options.mode, datetime.now(), changes)
    for table in run.quality_report(spark, options.root).values():
        table.show(50, truncate=False)
    run.read_gold(spark, options.root, "huerfanas").show()
    run.check_gold(star).where("fallos > 0").show(50, truncate=False)
    for query in (
        catalogue.monthly_revenue(star),
        catalogue.seat_utilisation(star, options.since),
        catalogue.channel_conversion(star),
        catalogue.lead_time(star),
        catalogue.booking_peaks(star),
    ):
        query.show(truncate=False)


if __name__ == "__main__":
    main()
