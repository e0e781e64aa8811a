"""Transform and load the valid staging rows into the order-system tables.

Each loader returns the inserted rows *with* their source ids, so key
lineage is a projection of the result rather than a side channel.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handover.functions.scalars import (
    COST_MARK,
    DEFAULT_COUNTRY,
    MONEY,
    PERCENT_MARK,
    TOTAL_MARK,
    customer_code,
    epoch_digits_to_ts,
    is_blank,
    money_to_units,
    parse_money,
    round_half_up_div,
)
from handover.operators.merge import append_with_keys, insert_missing, union_target
from handover.operators.sizing import measured
from handover.operators.skew import split_join
from handover.operators.validate import refers_to


#: Where generated keys start: (number of rows, first free key) -> key.
Reserve = Callable[[int, int], int] | None


class CodeCollisionError(ValueError):
    """Two new customers have one code (the source run breaks its key here)."""


class BadTotalError(ValueError):
    """A valid batch has no parseable total (the source run fails here)."""


def _valid(df: DataFrame):
    return F.col("is_valid") if "is_valid" in df.columns else F.lit(True)


def _party_source(entities_v: DataFrame, locations: DataFrame, flag: str) -> DataFrame:
    """Valid entities of one type with their address (inner join: no address, no row)."""
    e = entities_v.filter(_valid(entities_v) & (F.upper(F.col("type_flag")) == F.lit(flag)))
    loc = locations.select("location_id", "street_addr", "municipality", "region_code", "postal_code")
    return e.join(loc, e.location_ref == loc.location_id, "inner").select(
        "entity_id",
        "entity_label",
        F.col("contact_info").alias("phone"),
        F.col("street_addr").alias("address"),
        F.col("municipality").alias("city"),
        F.col("region_code").alias("region"),
        "postal_code",
        F.lit(DEFAULT_COUNTRY).alias("country"),
    )


def customer_candidates(entities_v: DataFrame, locations: DataFrame) -> DataFrame:
    s = _party_source(entities_v, locations, "A")
    return s.select(
        "entity_id",
        customer_code("entity_label").alias("customer_id"),
        F.col("entity_label").alias("company_name"),
        "phone", "address", "city", "region", "postal_code", "country",
    )


CUSTOMER_COLS = ["customer_id", "company_name", "phone", "address", "city", "region", "postal_code", "country"]


def load_customers(
    entities_v: DataFrame, locations: DataFrame, existing: DataFrame, on_code_collision: str = "report"
) -> dict[str, DataFrame]:
    """Insert customers whose code is not yet in the target.

    Two new entities with one code would both be 'not matched' and break the
    key; the lowest entity id wins and the others go to ``collisions``. An
    entity whose code belongs to a customer of another name that was there
    before isn't inserted, as in a merge, and is listed in ``clashes``. The
    winner is picked by ``min(struct(entity_id, ...))`` per code, an
    aggregate with map-side combine, so a very common code is not one task.
    ``on_code_collision="fail"`` raises instead, if there is any.
    """
    if on_code_collision not in ("report", "fail"):
        raise ValueError(f"on_code_collision: {on_code_collision!r}")
    cand = customer_candidates(entities_v, locations).filter(F.col("customer_id").isNotNull())
    new = insert_missing(existing, cand, ["customer_id"])
    rest = [c for c in new.columns if c not in ("customer_id", "entity_id")]
    winners = new.groupBy("customer_id").agg(F.min(F.struct("entity_id", *rest)).alias("w")).select(
        "customer_id", "w.*"
    )
    collisions = new.join(
        winners.select("customer_id", F.col("entity_id").alias("winner_entity_id")), "customer_id", "inner"
    ).filter(F.col("entity_id") != F.col("winner_entity_id"))
    if on_code_collision == "fail" and collisions.limit(1).count() > 0:  # an existence probe, not a collect
        raise CodeCollisionError("two new customers have one code")
    inserted = winners.select("entity_id", *CUSTOMER_COLS)
    # merged away by a customer that was there before, under another name
    held = existing.select("customer_id", F.col("company_name").alias("existing_company_name")).dropna(subset=["customer_id"])
    clashes = cand.join(held, "customer_id").filter(~F.col("company_name").eqNullSafe(F.col("existing_company_name")))
    return {
        "clashes": clashes.select("entity_id", "customer_id", "company_name", "existing_company_name"),
        "inserted": inserted,
        "collisions": collisions.select("entity_id", "customer_id", "company_name", "winner_entity_id"),
        "target": union_target(existing, inserted.withColumn("contact_name", F.lit(None).cast("string"))),
    }


def orders_unmatched(batches_v: DataFrame, entities_v: DataFrame, locations: DataFrame, customers: DataFrame) -> DataFrame:
    """(batch_id, entity_id, company_name, reason): valid batches whose entity is no target customer, so no order is made.

    ``NO_NAME``: the entity's name is blank. ``CODE_CLASH``: another customer, new
    or there before, has its code. ``NO_ADDRESS``: its location is unknown.
    ``NOT_A_CUSTOMER``: its flag isn't A. The reason is found per entity, before the
    batches are joined.
    """
    ent = entities_v.select("entity_id", "type_flag", F.col("entity_label").alias("company_name"))
    known = customers.filter(~is_blank("company_name")).select("company_name")
    lost = ent.filter(~is_blank("company_name")).join(known, "company_name", "left_anti")
    lost = lost.unionByName(ent.filter(is_blank("company_name")))
    candidates = customer_candidates(entities_v, locations).select("entity_id", F.lit(True).alias("__candidate"))
    reason = (
        F.when(is_blank("company_name"), "NO_NAME")
        .when(F.col("__candidate"), "CODE_CLASH")
        .when(F.upper("type_flag") == "A", "NO_ADDRESS")
        .otherwise("NOT_A_CUSTOMER")
    )
    lost = lost.join(candidates, "entity_id", "left").select("entity_id", "company_name", reason.alias("reason"))
    b = batches_v.filter(_valid(batches_v)).select("batch_id", F.col("reference_id").alias("entity_id"))
    return b.join(lost, "entity_id").select("batch_id", "entity_id", "company_name", "reason")


def lines_unmatched(transactions_v: DataFrame, items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """(transaction_id, batch_ref, item_ref, reason): valid lines that go into no order line.

    ``ORDER_NOT_LOADED``: the batch has no order; else ``PRODUCT_NOT_LOADED``: the
    item is unknown or no product has its name.
    """
    placed = orders.select(F.col("batch_id").alias("__batch"), F.lit(True).alias("__placed")).distinct()
    made = items.join(products.select(F.col("product_name").alias("label")).distinct(), "label", "left_semi")
    made = made.select(F.col("item_id").alias("__item"), F.lit(True).alias("__made")).distinct()
    t = transactions_v.filter(_valid(transactions_v)).select("transaction_id", "batch_ref", "item_ref")
    t = t.join(placed, refers_to(t, "batch_ref", "transaction_id", placed["__batch"]), "left")
    t = t.join(made, refers_to(t, "item_ref", "transaction_id", made["__item"]), "left")
    t = t.filter(F.col("__placed").isNull() | F.col("__made").isNull())
    reason = F.when(F.col("__placed").isNull(), "ORDER_NOT_LOADED").otherwise("PRODUCT_NOT_LOADED")
    return t.select("transaction_id", "batch_ref", "item_ref", reason.alias("reason"))


SUPPLIER_COLS = ["supplier_id", "company_name", "phone", "address", "city", "region", "postal_code", "country"]


def load_suppliers(entities_v: DataFrame, locations: DataFrame, existing: DataFrame, reserve: Reserve = None) -> dict[str, DataFrame]:
    """Insert suppliers whose company name is not yet in the target; new ids
    continue after the target's maximum, in entity id order."""
    cand = _party_source(entities_v, locations, "B").withColumnRenamed("entity_label", "company_name")
    new = insert_missing(existing, cand, ["company_name"])
    keyed = append_with_keys(existing, new, "supplier_id", ["entity_id"], reserve)
    inserted = keyed.select("entity_id", *SUPPLIER_COLS)
    return {"inserted": inserted, "target": union_target(existing, inserted)}


def _equal_join(left: DataFrame, right: DataFrame, key: str, to: str) -> DataFrame:
    return left.join(right, F.col(key) == F.col(to), "inner")


def load_products(
    items_v: DataFrame,
    entities: DataFrame,
    suppliers: DataFrame,
    existing: DataFrame | None = None,
    reserve: Reserve = None,
    split: bool = False,
) -> dict[str, DataFrame]:
    """Valid items; the supplier is found by the entity's name among all target
    suppliers (a name join: repeated names fan out, as in the source). Every
    row is a new product (ids in item id, supplier id order). ``split``: items
    of a supplier, and of a name, that many have are dealt to several tasks."""
    ent = entities.filter(~is_blank("entity_label")).select(
        F.col("entity_id").alias("__eid"), F.col("entity_label").alias("__ename")
    )
    sup = suppliers.filter(~is_blank("company_name")).select("supplier_id", F.col("company_name").alias("__sname"))
    i = items_v.filter(_valid(items_v))
    join = (lambda left, right, key, to: split_join(left, right, key, to, "inner", ["item_id"])) if split else _equal_join
    named = join(i.select("item_id", "label", "source_ref", "cost", "qty_available"), ent, "source_ref", "__eid")
    src = join(named, sup, "__ename", "__sname").select(
        "item_id",
        F.col("label").alias("product_name"),
        "supplier_id",
        parse_money("cost", COST_MARK).alias("unit_price"),
        F.col("qty_available").alias("units_in_stock"),
    )
    keyed = append_with_keys(existing, src, "product_id", ["item_id", "supplier_id"], reserve)
    inserted = keyed.select("product_id", "product_name", "supplier_id", "unit_price", "units_in_stock", "item_id")
    return {"inserted": inserted}


def load_orders(
    batches_v: DataFrame,
    entities: DataFrame,
    customers: DataFrame,
    existing: DataFrame | None = None,
    on_bad_total: str = "quarantine",
    reserve: Reserve = None,
    split: bool = False,
) -> dict[str, DataFrame]:
    """Valid batches; the customer is found by the entity's name. The order
    date is the first 10 epoch digits as seconds. The total is kept for the
    line load. A valid batch with no parseable total is quarantined
    (``on_bad_total="quarantine"``) or fails the run (``"fail"``). ``split``: the
    batches of an entity, and of a name, that many have are dealt to several
    tasks (``operators.skew``)."""
    ent = entities.filter(~is_blank("entity_label")).select(
        F.col("entity_id").alias("__eid"), F.col("entity_label").alias("__ename")
    )
    cus = customers.filter(~is_blank("company_name")).select("customer_id", F.col("company_name").alias("__cname"))
    b = batches_v.filter(_valid(batches_v))
    join = (lambda left, right, key, to: split_join(left, right, key, to, "inner", ["batch_id"])) if split else _equal_join
    named = join(b.select("batch_id", "batch_date", "reference_id", "total_value"), ent, "reference_id", "__eid")
    src = join(named, cus, "__ename", "__cname").select(
        "batch_id",
        parse_money("total_value", TOTAL_MARK).alias("total_value"),
        epoch_digits_to_ts("batch_date").alias("order_date"),
        "customer_id",
    )
    quarantined = src.filter(F.col("total_value").isNull())
    if on_bad_total == "fail":
        if quarantined.limit(1).count() > 0:  # an existence probe, not a collect
            raise BadTotalError("a valid batch has an unparseable total")
    elif on_bad_total != "quarantine":
        raise ValueError(f"on_bad_total: {on_bad_total!r}")
    ok = src.filter(F.col("total_value").isNotNull())
    keyed = append_with_keys(existing, ok, "order_id", ["batch_id", "customer_id"], reserve)
    inserted = keyed.select("order_id", "order_date", "customer_id", "batch_id", "total_value")
    return {"inserted": inserted, "quarantined": quarantined, "candidates": src}


def _valid_lines(transactions_v: DataFrame) -> DataFrame:
    return transactions_v.filter(_valid(transactions_v)).select(
        "transaction_id", "batch_ref", "item_ref", "qty", parse_money("amount", PERCENT_MARK).alias("pct")
    )


def _items(items: DataFrame) -> DataFrame:
    return items.select(F.col("item_id").alias("__iid"), F.col("label").alias("__label"))


def _products(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.col("product_name").alias("__pname"))


def _orders(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.col("batch_id").alias("__bid"), "total_value")


def line_sums(transactions_v: DataFrame, items: DataFrame) -> DataFrame:
    """(batch_ref, label, quantity, pct_sum): the valid lines by batch and item name.

    The one aggregate of the lines: the order lines and their lineage both read it.
    """
    it = _items(items)
    t = _valid_lines(transactions_v)
    named = t.join(it, t.item_ref == it["__iid"], "inner")
    return named.groupBy("batch_ref", F.col("__label").alias("label")).agg(F.sum("qty").alias("quantity"), F.sum("pct").alias("pct_sum"))


def load_order_details(
    transactions_v: DataFrame,
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    sums: DataFrame | None = None,
    split: bool = False,
) -> dict[str, DataFrame]:
    """One line per (order, product): quantity = sum of qty; unit price =
    total x sum(percent / 100) / sum(qty), computed exactly on integers and
    rounded half-up once to 4 places. Lines with zero quantity are
    quarantined instead of failing on the division. ``sums``: a written copy of
    ``line_sums``, if there is one.

    An order has one batch and a product one name, so the joins to products and
    orders yield exactly one row per (order, product): the source's GROUP BY
    needs no second shuffle, and repeated names fan out once per name rather
    than once per line. ``split``: deal the lines of a name that many have to
    several tasks (``operators.skew``).
    """
    sums = line_sums(transactions_v, items) if sums is None else sums
    p = _products(products)
    if split:
        named = split_join(sums, p, "label", "__pname", "inner", ["batch_ref"])
    else:
        named = sums.join(p, F.col("label") == F.col("__pname"), "inner")
    g = named.join(_orders(orders), F.col("batch_ref") == F.col("__bid"), "inner")
    # wider than long: a total of 461,168,602 at 100 % is 2**63 already
    num = money_to_units(F.col("total_value")).cast("decimal(19,0)") * money_to_units(F.col("pct_sum")).cast("decimal(19,0)")
    den = F.lit(1000000).cast("decimal(7,0)") * F.col("quantity").cast("decimal(19,0)")
    units = round_half_up_div(num, den)
    price = (units.cast("decimal(38,0)") * F.lit(Decimal("0.0001"))).cast(MONEY)
    ok = g.filter(F.col("quantity") != 0)
    inserted = ok.select("order_id", "product_id", "quantity", price.alias("unit_price"))
    quarantined = g.filter(F.col("quantity").isNull() | (F.col("quantity") == 0)).select("order_id", "product_id", "quantity")
    return {"inserted": inserted, "quarantined": quarantined}


def order_detail_lineage(
    transactions_v: DataFrame, items: DataFrame, products: DataFrame, orders: DataFrame, sums: DataFrame | None = None
) -> DataFrame:
    """Which source transactions went into which (order, product) line, one row
    per transaction and line (the n:m lineage, normalised rather than a
    comma list, so no group is gathered into one value). Lines that are not
    inserted (quantity zero or null, by ``line_sums``) have no lineage; these few
    groups are written once, so that Spark sees their size."""
    sums = line_sums(transactions_v, items) if sums is None else sums
    t = _valid_lines(transactions_v)
    it = _items(items)
    lines = t.join(it, t.item_ref == it["__iid"], "inner")
    not_inserted = measured(sums.where("quantity is null or quantity = 0").select("batch_ref", F.col("label").alias("__label")), "zero-quantity")
    return (
        lines.join(not_inserted, ["batch_ref", "__label"], "left_anti")
        .join(_products(products), F.col("__label") == F.col("__pname"), "inner")
        .join(_orders(orders), F.col("batch_ref") == F.col("__bid"), "inner")
        .select("order_id", "product_id", "transaction_id")
    )
