"""Row validation rules and the cascade of validity between staging tables.

Rules emit a stable error code; ``ERROR_MESSAGES`` gives the text. Each rule
is a per-row predicate or an aggregate joined back by key, so no rule sends
one whole key group to a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.operators.parallel import at_once
from handover.operators.sizing import measured
from handover.functions.scalars import (
    COST_MARK,
    PERCENT_MARK,
    TOTAL_MARK,
    is_blank,
    parse_money,
    parse_percent_int,
)

# Error codes and our wording of each rule.
ENTITY_NO_NAME = "ENTITY_NO_NAME"
ITEM_NO_NAME = "ITEM_NO_NAME"
ITEM_NO_COST = "ITEM_NO_COST"
ITEM_BAD_SUPPLIER = "ITEM_BAD_SUPPLIER"
BATCH_NO_TOTAL = "BATCH_NO_TOTAL"
BATCH_OVER_100 = "BATCH_OVER_100"
BATCH_UNDER_100 = "BATCH_UNDER_100"
BATCH_BAD_CUSTOMER = "BATCH_BAD_CUSTOMER"
TXN_DUPLICATE = "TXN_DUPLICATE"
TXN_NO_PERCENT = "TXN_NO_PERCENT"
TXN_BAD_ITEM = "TXN_BAD_ITEM"

ERROR_MESSAGES: dict[str, str] = {
    ENTITY_NO_NAME: "Entity has no name; it and the rows depending on it are not migrated.",
    ITEM_NO_NAME: "Item has no name; it and the rows depending on it are not migrated.",
    ITEM_NO_COST: "Item cost is missing or not a money value; it and the rows depending on it are not migrated.",
    ITEM_BAD_SUPPLIER: "Item refers to a missing or invalid supplier.",
    BATCH_NO_TOTAL: "Batch total is missing or not a money value; it and its lines are not migrated.",
    BATCH_OVER_100: "Batch line percentages add up to more than 100.",
    BATCH_UNDER_100: "Batch line percentages add up to less than 100.",
    BATCH_BAD_CUSTOMER: "Batch refers to a missing or invalid customer.",
    TXN_DUPLICATE: "Transaction duplicates an earlier one and is not migrated.",
    TXN_NO_PERCENT: "Transaction percentage is missing or not a number.",
    TXN_BAD_ITEM: "Transaction refers to an invalid item.",
}

# Table names written in the combined error report.
REPORT_TABLES = {"batches": "Batches", "entities": "Entity", "items": "Items", "transactions": "Transactions"}

# Columns compared by the duplicate rule (the source compares these three only).
DUP_KEYS = ("batch_ref", "item_ref", "date_key")


def message_of(code: Column | str) -> Column:
    """Error text for an error-code column."""
    code = F.col(code) if isinstance(code, str) else code
    lookup = F.create_map(*[x for k, v in ERROR_MESSAGES.items() for x in (F.lit(k), F.lit(v))])
    return lookup[code]


def _valid(df: DataFrame) -> Column:
    return F.col("is_valid") if "is_valid" in df.columns else F.lit(True)


def refers_to(df: DataFrame, ref: str, row_id: str, parent: Column) -> Column:
    """Outer-join condition of a nullable reference: null rows match nothing and
    are spread by their own id, or all of them would meet in one partition."""
    return (F.coalesce(df[ref], df[row_id]) == parent) & df[ref].isNotNull()


# ---------------------------------------------------------------- entity rules
def _entity_rule(flag: str, strict_type: bool) -> Column:
    typed = F.upper(F.col("type_flag")) == F.lit(flag)
    label = F.col("entity_label")
    if strict_type:
        return typed & is_blank(label)
    # As written in the source rule: `A AND label IS NULL OR trim(label) = ''`
    # binds as `(A AND label IS NULL) OR trim(label) = ''`.
    return (typed & label.isNull()) | (F.trim(label) == F.lit(""))


def bad_customers(entities: DataFrame, strict_type: bool = False) -> DataFrame:
    """Customer entities without a name: (entity_id, error_code)."""
    rule = F.coalesce(_entity_rule("A", strict_type), F.lit(False))
    return entities.filter(rule).select("entity_id", F.lit(ENTITY_NO_NAME).alias("error_code"))


def bad_suppliers(entities: DataFrame, strict_type: bool = False) -> DataFrame:
    """Supplier entities without a name: (entity_id, error_code)."""
    rule = F.coalesce(_entity_rule("B", strict_type), F.lit(False))
    return entities.filter(rule).select("entity_id", F.lit(ENTITY_NO_NAME).alias("error_code"))


def validate_entities(entities: DataFrame, strict_type: bool = False) -> DataFrame:
    """Entities with ``is_valid`` / ``validation_error`` set from both entity rules."""
    bad = F.coalesce(_entity_rule("A", strict_type) | _entity_rule("B", strict_type), F.lit(False))
    return _with_validity(entities, F.when(bad, F.lit(ENTITY_NO_NAME)))


# ------------------------------------------------------------------ item rules
def _item_code() -> Column:
    return F.when(is_blank("label"), F.lit(ITEM_NO_NAME)).when(
        parse_money("cost", COST_MARK).isNull(), F.lit(ITEM_NO_COST)
    )


def bad_items(items: DataFrame) -> DataFrame:
    """Items without a name or a parseable cost (first rule wins)."""
    return items.select("item_id", _item_code().alias("error_code")).filter(F.col("error_code").isNotNull())


def validate_items(items: DataFrame, entities_v: DataFrame) -> DataFrame:
    """Own rule first, else the supplier must exist, be of type B and be valid.

    Every other row is (re)set to valid.
    """
    sup = entities_v.filter(F.upper(F.col("type_flag")) == F.lit("B")).select(
        F.col("entity_id").alias("__sup_id"), F.col("is_valid").alias("__sup_valid")
    )
    j = items.join(sup, refers_to(items, "source_ref", "item_id", sup["__sup_id"]), "left")
    sup_ok = F.coalesce(F.col("__sup_valid"), F.lit(False))
    code = F.coalesce(_item_code(), F.when(~sup_ok, F.lit(ITEM_BAD_SUPPLIER)))
    return _with_validity(j, code).drop("__sup_id", "__sup_valid")


# ----------------------------------------------------------------- batch rules
def bad_batches(batches: DataFrame, transactions: DataFrame) -> DataFrame:
    """Batch total unparseable, or the percent sum of its *valid* lines is not 100.

    Lines are pre-aggregated per batch (map-side combine) before the join;
    batches without a valid line do not appear (inner join). A null sum gives
    a row with a null code.
    """
    lines = transactions.filter(_valid(transactions)).groupBy("batch_ref").agg(
        F.sum(parse_percent_int("amount", PERCENT_MARK)).alias("total_amount")
    )
    j = batches.select("batch_id", "total_value").join(lines, F.col("batch_id") == F.col("batch_ref"), "inner")
    parsed = parse_money("total_value", TOTAL_MARK)
    total = F.col("total_amount")
    code = (
        F.when(parsed.isNull(), F.lit(BATCH_NO_TOTAL))
        .when(total > 100, F.lit(BATCH_OVER_100))
        .when(total < 100, F.lit(BATCH_UNDER_100))
    )
    keep = parsed.isNull() | (total != 100) | total.isNull()
    return j.filter(keep).select("batch_id", code.alias("error_code"))


def validate_batches(
    batches: DataFrame,
    entities_v: DataFrame,
    enforce_batch_rules: bool = False,
    transactions_v: DataFrame | None = None,
) -> DataFrame:
    """Batch invalid when its entity is missing or invalid (any entity type).

    The batch rule (``bad_batches``) is reported but, as in the source, not
    enforced unless ``enforce_batch_rules``.
    """
    ent = entities_v.select(F.col("entity_id").alias("__ent_id"), F.col("is_valid").alias("__ent_valid"))
    j = batches.join(ent, refers_to(batches, "reference_id", "batch_id", ent["__ent_id"]), "left")
    code = F.when(~F.coalesce(F.col("__ent_valid"), F.lit(False)), F.lit(BATCH_BAD_CUSTOMER))
    if enforce_batch_rules:
        if transactions_v is None:
            raise ValueError("enforce_batch_rules needs transactions_v")
        rule = bad_batches(batches, transactions_v).filter(F.col("error_code").isNotNull())
        rule = rule.select(F.col("batch_id").alias("__rb"), F.col("error_code").alias("__rule"))
        j = j.join(rule, F.col("batch_id") == F.col("__rb"), "left")
        code = F.coalesce(code, F.col("__rule"))
        return _with_validity(j, code).drop("__ent_id", "__ent_valid", "__rb", "__rule")
    return _with_validity(j, code).drop("__ent_id", "__ent_valid")


# ----------------------------------------------------------- transaction rules
def _duplicate_groups(transactions: DataFrame, keys=DUP_KEYS) -> DataFrame:
    """Keys (``__s_...``) and lowest transaction id (``__first``) of the groups with more than one row.

    Partial per map task, so a hot group is combined before the shuffle. Written
    once, so that the planner sees its real size.
    """
    return measured(
        transactions.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.min("transaction_id").alias("__first"))
        .filter(F.col("__n") > 1)
        .select(*[F.col(k).alias(f"__s_{k}") for k in keys], "__first"),
        "duplicate-groups",
    )


def _with_survivor(transactions: DataFrame, keys=DUP_KEYS, groups: DataFrame | None = None) -> DataFrame:
    """Each row with the lowest transaction id of its duplicate group.

    Only groups with more than one row are joined back. They are usually few,
    and broadcast when under the threshold, leaving the large side unshuffled;
    with many duplicates it stays a sort-merge join and AQE splits skewed
    partitions. Keys are matched null-safely (nulls group together, as in SQL).
    """
    groups = _duplicate_groups(transactions, keys) if groups is None else groups
    cond = [transactions[k].eqNullSafe(groups[f"__s_{k}"]) for k in keys]
    return (
        transactions.join(groups, cond, "left")
        .withColumn("survivor_id", F.coalesce(F.col("__first"), F.col("transaction_id")))
        .drop("__first", *[f"__s_{k}" for k in keys])
    )


def duplicate_transactions(transactions: DataFrame, keys=DUP_KEYS) -> DataFrame:
    """Rows that are not the first (lowest id) of their duplicate group."""
    return (
        _with_survivor(transactions.select("transaction_id", *keys), keys)
        .filter(F.col("transaction_id") != F.col("survivor_id"))
        .select("transaction_id", *keys, "survivor_id")
    )


def _txn_code() -> Column:
    return F.when(F.col("transaction_id") != F.col("survivor_id"), F.lit(TXN_DUPLICATE)).when(
        parse_money("amount", PERCENT_MARK).isNull(), F.lit(TXN_NO_PERCENT)
    )


def bad_transactions(transactions: DataFrame, keys=DUP_KEYS) -> DataFrame:
    """Duplicates first, else an unparseable percentage."""
    t = _with_survivor(transactions.select("transaction_id", "amount", *keys), keys)
    return t.select("transaction_id", _txn_code().alias("error_code")).filter(F.col("error_code").isNotNull())


def validate_transactions(transactions: DataFrame, items_v: DataFrame, keys=DUP_KEYS) -> DataFrame:
    """Own rule first, else an invalid item. A missing item or an invalid
    batch does not invalidate the line (as in the source).

    Only the invalid items take part in the join: a line whose item is
    valid and a line whose item is missing are treated alike, so the small
    side is the invalid items, written once so the planner sees their real
    size and broadcasts them when under the threshold, leaving the large
    line table unshuffled.
    """
    groups, bad_items_ = at_once(
        lambda: _duplicate_groups(transactions, keys),
        lambda: measured(items_v.filter(~F.col("is_valid")).select(F.col("item_id").alias("__bad_item")), "invalid-items"),
    )
    t = _with_survivor(transactions, keys, groups)
    j = t.join(bad_items_, refers_to(t, "item_ref", "transaction_id", bad_items_["__bad_item"]), "left")
    code = F.coalesce(_txn_code(), F.when(F.col("__bad_item").isNotNull(), F.lit(TXN_BAD_ITEM)))
    return _with_validity(j, code).drop("survivor_id", "__bad_item")


# ---------------------------------------------------------------- report/util
def _with_validity(df: DataFrame, code: Column) -> DataFrame:
    base = df.drop("is_valid", "validation_error")
    return base.withColumn("validation_error", code).withColumn("is_valid", F.col("validation_error").isNull())


def error_report(
    entities: DataFrame,
    items_v: DataFrame,
    batches: DataFrame,
    transactions_v: DataFrame,
    strict_type: bool = False,
) -> DataFrame:
    """All rule hits in one frame (table_id, table_name, error_code, error_message).

    A distinct union: an entity reported by both entity rules appears once.
    The item and transaction hits are read off the cascaded tables (their own
    rule takes precedence there), so the duplicate search is not run twice;
    the batch rule reads the transactions' current validity.
    """
    own_items = items_v.filter(F.col("validation_error").isin(ITEM_NO_NAME, ITEM_NO_COST))
    own_txns = transactions_v.filter(F.col("validation_error").isin(TXN_DUPLICATE, TXN_NO_PERCENT))
    parts = [
        bad_batches(batches, transactions_v).select(F.col("batch_id").alias("table_id"), F.lit(REPORT_TABLES["batches"]).alias("table_name"), "error_code"),
        bad_customers(entities, strict_type).select(F.col("entity_id").alias("table_id"), F.lit(REPORT_TABLES["entities"]).alias("table_name"), "error_code"),
        bad_suppliers(entities, strict_type).select(F.col("entity_id").alias("table_id"), F.lit(REPORT_TABLES["entities"]).alias("table_name"), "error_code"),
        own_items.select(F.col("item_id").alias("table_id"), F.lit(REPORT_TABLES["items"]).alias("table_name"), F.col("validation_error").alias("error_code")),
        own_txns.select(
            F.col("transaction_id").alias("table_id"), F.lit(REPORT_TABLES["transactions"]).alias("table_name"), F.col("validation_error").alias("error_code")
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct().withColumn("error_message", message_of("error_code"))


def validate_all(sources: dict[str, DataFrame], strict_type: bool = False, enforce_batch_rules: bool = False) -> dict[str, DataFrame]:
    """Cascade in the source's order: entities, items, batches, transactions."""
    ent = validate_entities(sources["entities"], strict_type)
    itm = validate_items(sources["items"], ent)
    txn = validate_transactions(sources["transactions"], itm)
    bat = validate_batches(sources["batches"], ent, enforce_batch_rules, txn)
    return {"locations": sources["locations"], "entities": ent, "items": itm, "batches": bat, "transactions": txn}
