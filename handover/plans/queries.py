"""The registered queries: ``(spark, sf_dir) -> DataFrame`` over the given tables.

Output columns are aliased to the names the DuckDB oracle uses
(``handover.plans.oracle``). Money leaves as double computed from exact
integer ten-thousandths, flags as 0/1 ints, times as ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.functions.scalars import customer_code, money_to_units, units_to_double
from handover.operators import audit as A
from handover.operators import lineage as L
from handover.operators import validate as V
from handover.operators.keys import with_surrogate_key
from handover.operators.load import customer_candidates
from handover.operators.maintenance import shift_dates
from handover.operators.monthly import loyal_customers_from_months, month_states, read_states, write_states
from handover.operators.quality import (
    constraint_violations,
    stage_row_counts,
    staging_violations,
    with_quality_columns,
)
from handover.operators.reports import (
    customer_month_orders,
    customer_purchase_report,
    customers_with_orders,
    last_year_orders,
    loyal_customers,
)
from handover.plans.migration import MigrationOptions, migrate
from handover.session import scratch_path
from handover.sinks.bucketed import create_target, insert_missing_rows
from handover.sinks.ranged import RangedTable
from handover.sinks.staging import write_checked
from handover.sources import fixtures as fx
from handover.sources.tables import read_table

# Fixed parameters of the registered queries.
RUN_AS_OF = dt.datetime(2024, 5, 1)          # load time, lineage time, audit change time
REPORT_AS_OF = dt.datetime(2001, 8, 1)       # "now" of the loyal-customer report
PURCHASE_ALL = (dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31), None)
PURCHASE_CATEGORY = (dt.datetime(1997, 1, 1), dt.datetime(1997, 3, 31), "PROMO")
AUDIT_USER = "migration"
AUDIT_KEYS = ["c_custkey"]
PRODUCT_KEYS = ["p_partkey"]
SHIFT_YEARS = 26
ITEMS_A_RANGE = 100
BUCKETS = 8


def _money(c: str):
    return units_to_double(money_to_units(F.col(c))).alias(c)


def _flag(df: DataFrame) -> DataFrame:
    return df.withColumn("is_valid", F.col("is_valid").cast("int"))


def _migration(spark: SparkSession, d: str, **opts) -> dict[str, DataFrame]:
    src = fx.sources(spark, d)
    targets = {"customers": fx.existing_customers(spark, d), "suppliers": fx.existing_suppliers(spark, d)}
    return migrate(spark, src, targets, MigrationOptions(as_of=RUN_AS_OF, **opts))


def _validated(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return V.validate_all(fx.sources(spark, d))


# ------------------------------------------------------------------ sources
def q_extract_locations(spark, d):
    return fx.locations(spark, d)


def q_stage_entities(spark, d):
    return _flag(with_quality_columns(fx.entities(spark, d), RUN_AS_OF))


def q_stage_row_counts(spark, d):
    return stage_row_counts(fx.sources(spark, d))


def q_constraint_violations(spark, d):
    staging = staging_violations(fx.sources(spark, d))
    candidates = _migration(spark, d)["orders_candidates"]
    # The hand-over table of the order load declares the total NOT NULL.
    hand_over = constraint_violations(candidates, "Orders", "batch_id", not_null=["total_value"], max_lengths={})
    return staging.unionByName(hand_over)


def q_customer_code(spark, d):
    return fx.entities(spark, d).select("entity_id", customer_code("entity_label").alias("customer_code"))


# --------------------------------------------------------------- validation
def q_bad_customers(spark, d):
    return V.bad_customers(fx.entities(spark, d))


def q_bad_customers_strict(spark, d):
    return V.bad_customers(fx.entities(spark, d), strict_type=True)


def q_bad_suppliers(spark, d):
    return V.bad_suppliers(fx.entities(spark, d))


def q_bad_items(spark, d):
    return V.bad_items(fx.items(spark, d))


def q_bad_batches(spark, d):
    return V.bad_batches(fx.batches(spark, d), fx.transactions(spark, d))


def q_bad_batches_after_cascade(spark, d):
    v = _validated(spark, d)
    return V.bad_batches(v["batches"], v["transactions"])


def q_bad_transactions(spark, d):
    return V.bad_transactions(fx.transactions(spark, d))


def q_duplicate_transactions(spark, d):
    return V.duplicate_transactions(fx.transactions(spark, d))


def q_error_report(spark, d):
    v = _validated(spark, d)
    return V.error_report(v["entities"], v["items"], v["batches"], v["transactions"])


def q_validate_entities(spark, d):
    return _flag(_validated(spark, d)["entities"])


def q_validate_items(spark, d):
    return _flag(_validated(spark, d)["items"])


def q_validate_batches(spark, d):
    return _flag(_validated(spark, d)["batches"])


def q_validate_transactions(spark, d):
    return _flag(_validated(spark, d)["transactions"])


# --------------------------------------------------------------------- load
def q_load_customers(spark, d):
    return _migration(spark, d)["customers_inserted"]


def q_load_suppliers(spark, d):
    return _migration(spark, d)["suppliers_inserted"]


def q_load_products(spark, d):
    return _migration(spark, d)["products_inserted"].withColumn("unit_price", _money("unit_price"))


def q_load_orders(spark, d):
    return _migration(spark, d)["orders_inserted"].withColumn("total_value", _money("total_value"))


def q_load_order_details(spark, d):
    return _migration(spark, d)["order_details_inserted"].withColumn("unit_price", _money("unit_price"))


def q_load_order_details_lineage(spark, d):
    return _migration(spark, d)["order_detail_lineage"]


def q_customer_code_collisions(spark, d):
    return _migration(spark, d)["customer_code_collisions"]


def q_customer_code_clashes(spark, d):
    return _migration(spark, d)["customer_code_clashes"]


def q_orders_unmatched(spark, d):
    return _migration(spark, d)["orders_unmatched"]


def q_lines_unmatched(spark, d):
    return _migration(spark, d)["lines_unmatched"]


def q_orders_quarantined(spark, d):
    q = _migration(spark, d)["orders_quarantined"]
    return q.select("batch_id", "order_date", "customer_id")


def q_insert_log_customers(spark, d):
    return L.lineage(_migration(spark, d)["customers_inserted"], L.CUSTOMERS, RUN_AS_OF)


def q_insert_log_all(spark, d):
    return _migration(spark, d)["insert_log"]


def q_surrogate_keys(spark, d):
    t = fx.transactions(spark, d).select("transaction_id", "batch_ref")
    return with_surrogate_key(t, ["batch_ref", "transaction_id"], "line_key").select("transaction_id", "line_key")


# ------------------------------------------------------------------ reports
def _report_tables(spark, d):
    return fx.report_tables(spark, d)


def q_last_year_orders(spark, d):
    t = _report_tables(spark, d)
    return last_year_orders(t["orders"], t["order_details"], REPORT_AS_OF)


def q_customers_with_orders(spark, d):
    t = _report_tables(spark, d)
    return customers_with_orders(t["orders"], t["order_details"], t["customers"], REPORT_AS_OF)


def q_customer_month_orders(spark, d):
    t = _report_tables(spark, d)
    return customer_month_orders(t["orders"], t["order_details"], t["customers"], REPORT_AS_OF)


def q_loyal_customers(spark, d):
    t = _report_tables(spark, d)
    return loyal_customers(t["orders"], t["order_details"], t["customers"], REPORT_AS_OF)


def q_loyal_customers_from_months(spark, d):
    """The loyal report from monthly states that two runs have added, of even and of odd orders."""
    t = _report_tables(spark, d)
    root = scratch_path(spark, "months")
    for run in (0, 1):
        write_states(month_states(t["orders"].where(F.pmod("order_id", F.lit(2)) == run), t["order_details"]), root, f"run{run}")
    return loyal_customers_from_months(read_states(spark, root), t["orders"], t["order_details"], t["customers"], REPORT_AS_OF)


def q_purchase_report_all(spark, d):
    return customer_purchase_report(_report_tables(spark, d), *PURCHASE_ALL)


def q_purchase_report_category(spark, d):
    return customer_purchase_report(_report_tables(spark, d), *PURCHASE_CATEGORY)


def q_shift_order_dates(spark, d):
    o = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("order_date")
    )
    return shift_dates(o, ["order_date"], SHIFT_YEARS)


# -------------------------------------------------------------------- audit
def _audit_changes(spark, d) -> DataFrame:
    before, after = fx.customer_snapshots(spark, d)
    changes = A.audit_diff(before, after, AUDIT_KEYS, L.CUSTOMERS, RUN_AS_OF, AUDIT_USER)
    return A.with_log_ids(changes, AUDIT_KEYS)


_CHANGE_COLS = ["log_id", "table_name", "operation", "key_values", "old_values", "new_values"]


def q_audit_log(spark, d):
    return A.split_log(_audit_changes(spark, d))[0]


def q_audit_log_values(spark, d):
    return A.split_log(_audit_changes(spark, d))[1]


def q_audit_inserts(spark, d):
    return _audit_changes(spark, d).filter(F.col("operation") == A.INSERT).select(*_CHANGE_COLS)


def q_audit_updates(spark, d):
    return _audit_changes(spark, d).filter(F.col("operation") == A.UPDATE).select(*_CHANGE_COLS)


def q_audit_deletes(spark, d):
    return _audit_changes(spark, d).filter(F.col("operation") == A.DELETE).select(*_CHANGE_COLS)


def q_audit_stream(spark, d):
    from handover.streaming.audit_stream import run_audit_stream

    feed = fx.customer_change_feed(spark, d, RUN_AS_OF, AUDIT_USER)
    out = run_audit_stream(spark, feed, AUDIT_KEYS)
    return out.select("table_name", "operation", "key_values", "old_values", "new_values")


def _product_audit(spark, d) -> DataFrame:
    before, after = fx.product_snapshots(spark, d)
    return A.with_log_ids(A.audit_diff(before, after, PRODUCT_KEYS, L.PRODUCTS, RUN_AS_OF, AUDIT_USER), PRODUCT_KEYS)


def q_audit_products_log(spark, d):
    return A.split_log(_product_audit(spark, d))[0]


def q_audit_products_log_values(spark, d):
    return A.split_log(_product_audit(spark, d))[1]


def _stream_tables(spark, d) -> tuple[DataFrame, DataFrame]:
    from handover.streaming.audit_stream import run_log_stream

    return run_log_stream(
        spark,
        {
            L.CUSTOMERS: (fx.customer_change_feed(spark, d, RUN_AS_OF, AUDIT_USER), AUDIT_KEYS),
            L.PRODUCTS: (fx.product_change_feed(spark, d, RUN_AS_OF, AUDIT_USER), PRODUCT_KEYS),
        },
    )


def q_audit_stream_log(spark, d):
    return _stream_tables(spark, d)[0]


def q_audit_stream_values(spark, d):
    return _stream_tables(spark, d)[1]


def q_audit_run_log(spark, d):
    return A.split_log(_migration(spark, d, changed_by=AUDIT_USER)["audit_inserts"])[0]


def q_audit_run_values(spark, d):
    return A.split_log(_migration(spark, d, changed_by=AUDIT_USER)["audit_inserts"])[1]


def q_audit_log_by_digest(spark, d):
    before, after = fx.customer_snapshots(spark, d)
    changes = A.audit_diff_by_digest(before, after, AUDIT_KEYS, L.CUSTOMERS, RUN_AS_OF, AUDIT_USER)
    return A.split_log(A.with_log_ids(changes, AUDIT_KEYS))[0]


# ------------------------------------------------------- staging and updates
def q_staged_violations(spark, d):
    """The constraint report of the staging write."""
    root, parts = scratch_path(spark, "staged"), []
    for t, df in fx.sources(spark, d).items():
        parts.append(write_checked(df, t, f"{root}/{t}", RUN_AS_OF).violations)
    return reduce(DataFrame.unionByName, parts)


def q_items_revalidated(spark, d):
    """Staged items with all flags true, updated by the cascade in the ranges that change."""
    table = RangedTable(spark, scratch_path(spark, "items"), "item_id", ITEMS_A_RANGE)
    staged = with_quality_columns(fx.items(spark, d), RUN_AS_OF).drop("load_timestamp")
    table.create(staged)
    table.update(_validated(spark, d)["items"].select(*staged.columns), ["is_valid", "validation_error"])
    return _flag(table.read())


def q_merge_customers_bucketed(spark, d):
    """Keys and names of the target customers after a merge by bucket."""
    keys, name = ["customer_id"], f"customers_{uuid.uuid4().hex[:12]}"
    cols = ["customer_id", "company_name"]
    create_target(fx.existing_customers(spark, d).select(*cols), name, keys, BUCKETS)
    v = _validated(spark, d)
    insert_missing_rows(spark, name, customer_candidates(v["entities"], v["locations"]).select(*cols).dropna(subset=keys), keys)
    return spark.table(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
