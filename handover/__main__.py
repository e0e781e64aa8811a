"""Command line: run a migration, a report or a maintenance step as a Spark job.

    python -m handover migrate --fixtures DIR --root OUT --run-id r1
    python -m handover migrate --extracts DIR --customers C.parquet --suppliers S.parquet --root OUT --run-id r1
    python -m handover migrate --jdbc-url jdbc:... --jdbc-property user=u --customers C.parquet --suppliers S.parquet --root OUT --run-id r1
    python -m handover purchase-report (--fixtures DIR | --tables DIR | --root OUT --tables DIR) --start 1997-01-01 --end 1997-03-31 [--category PROMO] --out OUT
    python -m handover loyal-report (--fixtures DIR | --tables DIR | --root OUT --tables DIR) --as-of 2001-08-01 --out OUT
    python -m handover audit --before B.parquet --after A.parquet --key customer_id --table Customers --out OUT
    python -m handover shift-dates --input T.parquet --column order_date --years 26 --out OUT

Extracts: ``DIR/<table>`` parquet folders for locations, batches, entities,
items, transactions. Report tables: ``DIR/<table>`` for orders, customers,
order_details, products, categories; with ``--root`` the rows that committed runs
have published are added to them. The session is the one ``spark-submit``
provides (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession


def _session() -> SparkSession:
    from handover.session import ensure_checkpoint_dir, local_session

    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    return local_session()


def _date(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def _now() -> dt.datetime:
    return dt.datetime.now().replace(microsecond=0)


def _write(df: DataFrame, args: argparse.Namespace) -> int:
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(args.out) if args.csv else writer.parquet(args.out)
    return 0


def _properties(pairs: list[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def cmd_migrate(args: argparse.Namespace) -> int:
    from handover.plans.migration import MigrationOptions, run_migration
    from handover.sources import fixtures as fx
    from handover.sources.tables import SOURCE_ORDER, read_all_jdbc, read_all_sources

    spark = _session()
    if args.fixtures:
        sources = fx.sources(spark, args.fixtures)
        targets = {"customers": fx.existing_customers(spark, args.fixtures), "suppliers": fx.existing_suppliers(spark, args.fixtures)}
    else:
        if args.jdbc_url:
            sources = read_all_jdbc(spark, args.jdbc_url, _properties(args.jdbc_property), args.rows_per_range)
        else:
            sources = read_all_sources(spark, {t: f"{args.extracts.rstrip('/')}/{t}" for t in SOURCE_ORDER})
        from handover.schemas import CUSTOMERS, SUPPLIERS
        from handover.sources.tables import conform

        targets = {
            "customers": conform(spark.read.parquet(args.customers), CUSTOMERS, "customers"),
            "suppliers": conform(spark.read.parquet(args.suppliers), SUPPLIERS, "suppliers"),
        }
    opts = MigrationOptions(
        as_of=_date(args.as_of) if args.as_of else _now(),
        strict_type=args.strict_type,
        enforce_batch_rules=args.enforce_batch_rules,
        on_bad_total=args.on_bad_total,
        on_code_collision=args.on_code_collision,
        on_violation=args.on_violation,
        split_heavy=args.split_heavy,
    )
    out = run_migration(spark, sources, targets, args.root, args.run_id, opts)
    print(json.dumps({"run_id": args.run_id, "root": args.root, "tables": out.written}))
    return 0


def _report_tables(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    from handover.operators.reports import report_tables
    from handover.sources import fixtures as fx

    if args.fixtures:
        return fx.report_tables(spark, args.fixtures)
    return report_tables(spark, args.tables, args.root)


def cmd_purchase_report(args: argparse.Namespace) -> int:
    from handover.operators.reports import PURCHASE_REPORT_LABELS, customer_purchase_report, with_display_labels

    df = customer_purchase_report(_report_tables(_session(), args), _date(args.start), _date(args.end), args.category)
    return _write(with_display_labels(df, PURCHASE_REPORT_LABELS) if args.labels else df, args)


def cmd_loyal_report(args: argparse.Namespace) -> int:
    from handover.operators.reports import LOYAL_REPORT_LABELS, loyal_customers, with_display_labels

    t = _report_tables(_session(), args)
    as_of = _date(args.as_of) if args.as_of else _now()
    df = loyal_customers(t["orders"], t["order_details"], t["customers"], as_of, args.min_orders, args.count_orders)
    return _write(with_display_labels(df, LOYAL_REPORT_LABELS) if args.labels else df, args)


def cmd_audit(args: argparse.Namespace) -> int:
    """Log and LogValues of the changes between two snapshots."""
    from handover.operators.audit import audit_diff, split_log, with_log_ids

    spark = _session()
    changes = audit_diff(
        spark.read.parquet(args.before), spark.read.parquet(args.after), args.key, args.table, _date(args.as_of) if args.as_of else _now(), args.changed_by
    )
    for name, df in zip(("log", "log_values"), split_log(with_log_ids(changes, args.key))):
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    return 0


def cmd_shift_dates(args: argparse.Namespace) -> int:
    from handover.operators.maintenance import shift_dates

    return _write(shift_dates(_session().read.parquet(args.input), args.column, args.years), args)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m handover")
    sub = p.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("migrate", help="stage, validate, load and publish one run")
    src = m.add_mutually_exclusive_group(required=True)
    src.add_argument("--fixtures", help="derive the legacy tables from a provided sf folder")
    src.add_argument("--extracts", help="folder with one parquet folder per legacy table")
    src.add_argument("--jdbc-url", help="read the legacy tables from a relational source")
    m.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="connection property, e.g. user, password, driver")
    m.add_argument("--rows-per-range", type=int, default=1_000_000, help="keys read by one connection")
    m.add_argument("--customers", help="existing target customers (parquet), unless --fixtures")
    m.add_argument("--suppliers", help="existing target suppliers (parquet), unless --fixtures")
    m.add_argument("--root", required=True, help="publish root (shared storage)")
    m.add_argument("--run-id", required=True)
    m.add_argument("--as-of", help="load time written on staging and lineage (ISO)")
    m.add_argument("--strict-type", action="store_true")
    m.add_argument("--enforce-batch-rules", action="store_true")
    m.add_argument("--on-bad-total", choices=["quarantine", "fail"], default="quarantine")
    m.add_argument("--on-code-collision", choices=["report", "fail"], default="report")
    m.add_argument("--on-violation", choices=["report", "fail", "quarantine"], default="report")
    m.add_argument("--split-heavy", action="store_true", help="deal the rows of heavy names to several tasks")
    m.set_defaults(fn=cmd_migrate)

    def report(name: str, text: str) -> argparse.ArgumentParser:
        r = sub.add_parser(name, help=text)
        of = r.add_mutually_exclusive_group(required=True)
        of.add_argument("--fixtures", help="map the report tables onto a provided sf folder")
        of.add_argument("--tables", help="folder with one parquet folder per report table")
        r.add_argument("--root", help="publish root whose committed rows are added, with --tables")
        r.add_argument("--labels", action="store_true", help="display labels as column names")
        return r

    def output(r: argparse.ArgumentParser, fn) -> None:
        r.add_argument("--csv", action="store_true")
        r.add_argument("--out", required=True)
        r.set_defaults(fn=fn)

    r = report("purchase-report", "customer purchase report")
    r.add_argument("--start", required=True)
    r.add_argument("--end", required=True)
    r.add_argument("--category")
    output(r, cmd_purchase_report)

    r = report("loyal-report", "loyal customers of the trailing year")
    r.add_argument("--as-of", help="end of the year (ISO); now if not given")
    r.add_argument("--min-orders", type=int, default=5)
    r.add_argument("--count-orders", action="store_true", help="count orders a month instead of lines")
    output(r, cmd_loyal_report)

    r = sub.add_parser("audit", help="log the changes between two snapshots of a table")
    r.add_argument("--before", required=True)
    r.add_argument("--after", required=True)
    r.add_argument("--key", action="append", required=True)
    r.add_argument("--table", required=True)
    r.add_argument("--as-of")
    r.add_argument("--changed-by")
    r.add_argument("--out", required=True)
    r.set_defaults(fn=cmd_audit)

    r = sub.add_parser("shift-dates", help="move date columns by years")
    r.add_argument("--input", required=True)
    r.add_argument("--column", action="append", required=True)
    r.add_argument("--years", type=int, required=True)
    output(r, cmd_shift_dates)

    args = p.parse_args(argv)
    if args.cmd == "migrate" and not args.fixtures and not (args.customers and args.suppliers):
        p.error("--extracts and --jdbc-url need --customers and --suppliers")
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
