"""The migration as one lazy plan: stage -> validate -> load -> lineage.

``migrate`` only builds DataFrames; ``run_migration`` materialises the
validated staging and the keyed loads once (written to the shared scratch
folder, which also cuts lineage and keeps generated keys fixed), then
``publish_run`` writes every output under a run id and marks the run
complete last.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from handover.operators import audit
from handover.operators import lineage as lin
from handover.operators import load
from handover.operators.load import (
    load_customers,
    load_order_details,
    load_orders,
    load_products,
    load_suppliers,
    order_detail_lineage,
)
from handover.operators.quality import constraint_violations, enforce, staging_violations, with_quality_columns
from handover.operators.parallel import at_once
from handover.operators.sizing import measured
from handover.operators.validate import validate_all
from handover.schemas import SOURCE_KEYS
from handover.session import scratch_path
from handover.sinks.keyranges import reserve
from handover.sinks.staging import write_checked
from handover.sinks.publish import new_attempt, publish_run, refuse_committed, table_path, write_table


# File layout of published tables, in place of the source's two optional
# indexes: rows sorted inside each file so parquet min/max statistics prune
# row groups for lookups by these columns (a local sort, no shuffle).
PUBLISH_LAYOUT: dict[str, list[str]] = {
    "orders_inserted": ["customer_id", "order_id"],
    "order_details_inserted": ["order_id", "product_id"],
}


# Outputs used between steps only (the order candidates feed the constraint
# report and the quarantine list, which are published themselves).
INTERNAL_OUTPUTS = frozenset({"orders_candidates"})


@dataclass
class MigrationOptions:
    as_of: dt.datetime = field(default_factory=lambda: dt.datetime.now().replace(microsecond=0))
    strict_type: bool = False          # entity rules as intended, not as the source's precedence
    enforce_batch_rules: bool = False  # apply the batch percent rule in the cascade
    on_bad_total: str = "quarantine"   # or "fail"
    on_code_collision: str = "report"  # or "fail"
    changed_by: str | None = None      # of the audit of inserted rows; the session's user if not given
    on_violation: str = "report"       # declared constraints, in run_migration; or "fail", "quarantine"
    split_heavy: bool = False          # find heavy names and keys by a sketch, deal their rows to several tasks
    materialize: bool = False          # write intermediate tables once, then read them back
    publish_root: str | None = None    # write them straight into this run's published location
    run_id: str | None = None
    attempt: str | None = None


def _materialize(spark: SparkSession, df: DataFrame, name: str, o: "MigrationOptions", written: dict[str, int]) -> DataFrame:
    """Write ``df`` once and read it back (cuts lineage, fixes generated keys).

    With a publish root the copy goes straight to the run's partition of the
    published table, so publishing does not write it a second time; the row
    count is observed during the write.
    """
    if o.publish_root and o.run_id:
        if name in PUBLISH_LAYOUT:
            df = df.sortWithinPartitions(*PUBLISH_LAYOUT[name])
        obs = Observation(f"rows_{name}")
        write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), o.publish_root, name, o.run_id, o.attempt)
        written[name] = int(obs.get["rows"])
        return spark.read.parquet(table_path(o.publish_root, name, o.run_id, o.attempt))
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


class _Outputs(Mapping):
    """Read-only mapping whose values are built on first access, once.

    Keyed loads write their numbering to the scratch folder when built, so a
    caller asking only for the customer load does not number suppliers,
    products and orders.
    """

    def __init__(self, written: dict[str, int], builders: dict[str, Callable[[], DataFrame]]):
        self.written = written  # outputs already written to the publish root, with row counts
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, key: str) -> DataFrame:
        if key not in self._built:
            self._built[key] = self._builders[key]()
        return self._built[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def migrate(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    targets: dict[str, DataFrame],
    options: MigrationOptions | None = None,
) -> Mapping[str, DataFrame]:
    """All migration outputs, as a mapping of DataFrames built on demand.

    ``sources``: locations, entities, items, batches, transactions (legacy).
    ``targets``: customers, suppliers (existing rows); products/orders optional.
    """
    o = options or MigrationOptions()
    written: dict[str, int] = {}
    keep = (lambda df, name: _materialize(spark, df, name, o, written)) if o.materialize else (lambda df, name: df)
    step: dict[str, object] = {}

    def keys_of(table: str):
        """How a published run takes keys; without a root they simply follow the target's."""
        return (lambda n, first: reserve(spark, o.publish_root, table, n, first)) if o.publish_root else None

    def once(name: str, fn: Callable[[], object]):
        lock = Lock()  # steps run at once wait for one they share; a step only asks for earlier ones

        def get():
            with lock:
                if name not in step:
                    step[name] = fn()
            return step[name]

        return get

    def _validated():
        staged = {k: with_quality_columns(v, o.as_of) for k, v in sources.items()}
        v = validate_all(staged, o.strict_type, o.enforce_batch_rules)
        kept = at_once(*(lambda k=k, df=df: keep(df, f"validated_{k}") for k, df in v.items()))
        return dict(zip(v, kept))

    validated = once("validated", _validated)
    cust = once("cust", lambda: load_customers(validated()["entities"], validated()["locations"], targets["customers"], o.on_code_collision))
    cust_ins = once("cust_ins", lambda: keep(cust()["inserted"], "customers_inserted"))

    def _customers_all():
        cols = targets["customers"].columns
        return targets["customers"].unionByName(cust_ins().withColumn("contact_name", F.lit(None).cast("string")).select(*cols))

    customers_all = once("customers_all", _customers_all)
    sup = once("sup", lambda: load_suppliers(validated()["entities"], validated()["locations"], targets["suppliers"], keys_of("suppliers")))
    sup_ins = once("sup_ins", lambda: keep(sup()["inserted"], "suppliers_inserted"))
    suppliers_all = once(
        "suppliers_all",
        lambda: targets["suppliers"].unionByName(sup_ins().select(*targets["suppliers"].columns)),
    )
    prod = once("prod", lambda: load_products(validated()["items"], validated()["entities"], suppliers_all(), targets.get("products"), keys_of("products"), o.split_heavy))
    prod_ins = once("prod_ins", lambda: keep(prod()["inserted"], "products_inserted"))
    orders = once(
        "orders",
        lambda: load_orders(validated()["batches"], validated()["entities"], customers_all(), targets.get("orders"), o.on_bad_total, keys_of("orders"), o.split_heavy),
    )
    ord_ins = once("ord_ins", lambda: keep(orders()["inserted"], "orders_inserted"))
    def _sums():
        summed = load.line_sums(validated()["transactions"], validated()["items"])
        return measured(summed, "line-sums") if o.materialize else summed  # a run reads it twice

    sums = once("line_sums", _sums)

    def keyed():
        """Products, orders and line sums: none needs another."""
        validated()
        return at_once(prod_ins, ord_ins, sums)

    def _lines():
        products, placed, summed = keyed()
        return load_order_details(validated()["transactions"], validated()["items"], products, placed, summed, o.split_heavy)

    def _line_lineage():
        products, placed, summed = keyed()
        return order_detail_lineage(validated()["transactions"], validated()["items"], products, placed, summed)

    lines = once("lines", _lines)
    line_lineage = once("line_lineage", _line_lineage)

    def _log():
        return lin.insert_log(
            {
                lin.CUSTOMERS: cust_ins(),
                lin.SUPPLIERS: sup_ins(),
                lin.PRODUCTS: prod_ins(),
                lin.ORDERS: ord_ins(),
                lin.ORDER_DETAILS: line_lineage(),
            },
            o.as_of,
        )

    def _audit():
        # what the insert triggers of the two audited tables log
        columns = [c for c in targets["customers"].columns if c in cust_ins().columns]
        made = {lin.CUSTOMERS: (cust_ins().select(*columns), ["customer_id"]), lin.PRODUCTS: (prod_ins().drop("item_id"), ["product_id"])}
        rows = [audit.audit_inserts(df, keys, table, o.as_of, o.changed_by) for table, (df, keys) in made.items()]
        return keep(audit.with_log_ids(rows[0].unionByName(rows[1]), ["key_values"]), "audit_inserts")

    return _Outputs(
        written,
        {
            "validated_locations": lambda: validated()["locations"],
            "validated_entities": lambda: validated()["entities"],
            "validated_items": lambda: validated()["items"],
            "validated_batches": lambda: validated()["batches"],
            "validated_transactions": lambda: validated()["transactions"],
            "customers_inserted": cust_ins,
            "customer_code_collisions": lambda: cust()["collisions"],
            "customer_code_clashes": lambda: cust()["clashes"],
            "suppliers_inserted": sup_ins,
            "products_inserted": prod_ins,
            "orders_inserted": ord_ins,
            "orders_quarantined": lambda: orders()["quarantined"],
            "orders_unmatched": once(
                "orders_unmatched",
                lambda: load.orders_unmatched(validated()["batches"], validated()["entities"], validated()["locations"], customers_all()),
            ),
            "lines_unmatched": once(
                "lines_unmatched",
                lambda: load.lines_unmatched(validated()["transactions"], validated()["items"], prod_ins(), ord_ins()),
            ),
            "orders_candidates": lambda: orders()["candidates"],
            "order_details_inserted": lambda: lines()["inserted"],
            "order_details_quarantined": lambda: lines()["quarantined"],
            "order_detail_lineage": line_lineage,
            "insert_log": once("log", _log),
            "audit_inserts": once("audit", _audit),
        }
    )


def check_sources(sources: dict[str, DataFrame], mode: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The sources to load, and the tables to publish about their declared constraints.

    ``"report"`` loads all rows; ``"fail"`` raises on any breach, as the source's
    failing statement ends its run; ``"quarantine"`` sets the rows with a breach aside.
    """
    if mode not in ("report", "fail", "quarantine"):
        raise ValueError(f"on_violation: {mode!r}")
    about = {"source_violations": staging_violations(sources)}
    if mode == "report":
        return sources, about
    clean = {}
    for t, df in sources.items():
        breaches = constraint_violations(df, t, SOURCE_KEYS[t], primary_key=SOURCE_KEYS[t])
        split = enforce(df, breaches, SOURCE_KEYS[t], mode)
        clean[t] = split["clean"]
        if mode == "quarantine":
            about[f"quarantined_{t}"] = split["quarantined"]
    return clean, about


def stage_sources(
    sources: dict[str, DataFrame], root: str, run_id: str, attempt: str, as_of: dt.datetime, mode: str
) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, int]]:
    """Land every source as a staged table of the run, checked while it is written.

    Returns the rows to load (read from the staged copies, so a source is read
    once in a run), the tables to publish about broken constraints, and the
    numbers of staged rows.
    """
    clean, about, written, parts = {}, {}, {}, []
    write = lambda t, df: write_checked(df, t, table_path(root, f"staged_{t}", run_id, attempt), as_of, mode)
    staged = at_once(*(lambda t=t, df=df: write(t, df) for t, df in sources.items()))
    for (t, df), done in zip(sources.items(), staged):
        clean[t], written[f"staged_{t}"] = done.clean.select(*df.columns), done.rows
        parts.append(done.violations)
        if mode == "quarantine":
            about[f"quarantined_{t}"] = done.quarantined.select(*df.columns)
    return clean, {"source_violations": reduce(DataFrame.unionByName, parts)} | about, written


def run_migration(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    targets: dict[str, DataFrame],
    root: str,
    run_id: str,
    options: MigrationOptions | None = None,
) -> Mapping[str, DataFrame]:
    """Stage the sources, migrate with validated and keyed tables written once,
    straight into the run's published location, then publish the rest and commit
    the run. Breaches of the declared constraints, found while staging, are
    published too, or stop the run before it loads (``MigrationOptions.on_violation``)."""
    refuse_committed(spark, root, run_id)
    o = replace(options or MigrationOptions(), materialize=True, publish_root=root, run_id=run_id, attempt=new_attempt())
    sources, about, staged = stage_sources(sources, root, run_id, o.attempt, o.as_of, o.on_violation)
    out = migrate(spark, sources, targets, o)
    out.written.update(staged)
    # builds (and writes) every step; internal hand-over frames are not published
    built = {name: out[name] for name in out if name not in INTERNAL_OUTPUTS} | about
    built = {n: df.sortWithinPartitions(*PUBLISH_LAYOUT[n]) if n in PUBLISH_LAYOUT else df for n, df in built.items()}
    publish_run(spark, built, root, run_id, o.as_of, already_written=out.written, attempt=o.attempt)
    return out
