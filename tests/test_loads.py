import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from handover.operators import load as LD
from handover.operators.merge import insert_missing
from handover.plans.migration import MigrationOptions, migrate
from handover.sources import fixtures as fx
from conftest import SF_SMALL

ENT = "entity_id int, entity_label string, type_flag string, location_ref int, contact_info string, is_valid boolean"
LOC = "location_id int, street_addr string, municipality string, region_code string, postal_code string"
CUS = "customer_id string, company_name string, contact_name string, phone string, address string, city string, region string, postal_code string, country string"
SUP = "supplier_id long, company_name string, phone string, address string, city string, region string, postal_code string, country string"


def test_insert_missing(spark):
    target = spark.createDataFrame([("K1",), (None,)], "k string")
    source = spark.createDataFrame([("K1", 1), ("K2", 2), ("K2", 3), (None, 4)], "k string, v int")
    got = sorted(r.v for r in insert_missing(target, source, ["k"]).collect())
    assert got == [2, 3, 4]


def test_customer_collision_keeps_lowest_entity(spark):
    loc = spark.createDataFrame([(1, "a", "b", "c", "d")], LOC)
    # " Acme" and "Acme" trim to the same name: the same code.
    ent = spark.createDataFrame([(7, "Acme", "A", 1, "p", True), (3, " Acme", "a", 1, "q", True), (9, "Zed", "A", 1, "r", True)], ENT)
    existing = spark.createDataFrame([], CUS)
    out = LD.load_customers(ent, loc, existing)
    ins = {r.customer_id: r.entity_id for r in out["inserted"].collect()}
    assert ins["A693C"] == 3 and len(ins) == 2
    assert [r.entity_id for r in out["collisions"].collect()] == [7]
    with pytest.raises(LD.CodeCollisionError):
        LD.load_customers(ent, loc, existing, on_code_collision="fail")
    # second run: everything matches, nothing is inserted
    again = LD.load_customers(ent, loc, out["target"])
    assert again["inserted"].count() == 0


def test_supplier_ids_continue_after_max(spark):
    loc = spark.createDataFrame([(1, "a", "b", "c", "d")], LOC)
    ent = spark.createDataFrame([(30, "S3", "B", 1, "p", True), (10, "S1", "B", 1, "q", True), (20, "Old", "B", 1, "r", True)], ENT)
    existing = spark.createDataFrame([(41, "Old", None, None, None, None, None, "USA")], SUP)
    got = {r.company_name: r.supplier_id for r in LD.load_suppliers(ent, loc, existing)["inserted"].collect()}
    assert got == {"S1": 42, "S3": 43}


def test_order_line_price(spark):
    txn = spark.createDataFrame(
        [(1, 1, 1, 3, "50%", True), (2, 1, 1, 1, "25%", True), (3, 1, 2, 2, "25%", True), (4, 1, 3, 5, "40%", True)],
        "transaction_id int, batch_ref int, item_ref int, qty int, amount string, is_valid boolean",
    )
    items = spark.createDataFrame([(1, "P"), (2, "Q"), (3, "Z")], "item_id int, label string")
    products = spark.createDataFrame([(100, "P"), (200, "Q")], "product_id long, product_name string")
    orders = spark.createDataFrame([(9, 1, Decimal("1000.0000"))], "order_id long, batch_id int, total_value decimal(19,4)")
    out = LD.load_order_details(txn, items, products, orders)
    got = {r.product_id: (r.quantity, r.unit_price) for r in out["inserted"].collect()}
    # P: 1000 * 0.75 / 4 = 187.5 ; Q: 1000 * 0.25 / 2 = 125
    assert got == {100: (4, Decimal("187.5000")), 200: (2, Decimal("125.0000"))}
    lineage = sorted((r.product_id, r.transaction_id) for r in LD.order_detail_lineage(txn, items, products, orders).collect())
    assert lineage == [(100, 1), (100, 2), (200, 3)]


def test_zero_quantity_is_quarantined(spark):
    txn = spark.createDataFrame([(1, 1, 1, 0, "100%", True)], "transaction_id int, batch_ref int, item_ref int, qty int, amount string, is_valid boolean")
    items = spark.createDataFrame([(1, "P")], "item_id int, label string")
    products = spark.createDataFrame([(100, "P")], "product_id long, product_name string")
    orders = spark.createDataFrame([(9, 1, Decimal("10"))], "order_id long, batch_id int, total_value decimal(19,4)")
    out = LD.load_order_details(txn, items, products, orders)
    assert out["inserted"].count() == 0 and out["quarantined"].count() == 1
    assert LD.order_detail_lineage(txn, items, products, orders).count() == 0  # nothing inserted, nothing logged


def test_price_is_exact_for_either_sign_and_large_totals(spark):
    schema = "transaction_id int, batch_ref int, item_ref int, qty int, amount string, is_valid boolean"
    txn = spark.createDataFrame([(1, 1, 1, -2, "100%", True), (2, 2, 1, 3, "100%", True)], schema)
    items = spark.createDataFrame([(1, "P")], "item_id int, label string")
    products = spark.createDataFrame([(100, "P")], "product_id long, product_name string")
    orders = spark.createDataFrame([(8, 1, Decimal("100")), (9, 2, Decimal("999999999"))], "order_id long, batch_id int, total_value decimal(19,4)")
    got = {r.order_id: r.unit_price for r in LD.load_order_details(txn, items, products, orders)["inserted"].collect()}
    assert got == {8: Decimal("-50.0000"), 9: Decimal("333333333.0000")}
    assert LD.order_detail_lineage(txn, items, products, orders).count() == 2


def test_pipeline_properties(spark):
    src = fx.sources(spark, SF_SMALL)
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    out = migrate(spark, src, targets, MigrationOptions(as_of=dt.datetime(2024, 5, 1)))
    log = out["insert_log"]
    # each inserted key appears once in the lineage
    for table in ["Customers", "Suppliers", "Products", "Orders"]:
        part = log.filter(F.col("table_name") == table)
        assert part.count() == part.select("target_key").distinct().count() > 0
    # generated keys are 1..n without gaps
    ids = sorted(r.order_id for r in out["orders_inserted"].select("order_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    # lines reference loaded orders and products only
    assert out["order_details_inserted"].join(out["orders_inserted"], "order_id", "left_anti").count() == 0
    # sum(line qty x price) = order total x (sum of the percents behind the lines) / 100,
    # up to the 4-place rounding of each unit price
    lines = out["order_details_inserted"].groupBy("order_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("s"), F.sum("quantity").alias("q")
    )
    pct = (
        out["order_detail_lineage"]
        .join(out["validated_transactions"].select("transaction_id", "amount"), "transaction_id")
        .groupBy("order_id")
        .agg(F.sum(F.regexp_replace("amount", "%", "").cast("decimal(19,4)")).alias("p"))
    )
    chk = (
        out["orders_inserted"].join(lines, "order_id").join(pct, "order_id")
        .filter(F.abs(F.col("s") - F.col("total_value") * F.col("p") / 100) > F.col("q") * F.lit(0.00005) + F.lit(0.0001))
    )
    assert chk.count() == 0


def test_bad_total_fail_mode(spark):
    import pytest

    src = fx.sources(spark, SF_SMALL)
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    out = migrate(spark, src, targets, MigrationOptions(on_bad_total="fail"))
    with pytest.raises(LD.BadTotalError):
        out["orders_inserted"]  # the check runs when the order load is built


def test_second_supplier_run_inserts_nothing(spark):
    loc = spark.createDataFrame([(1, "a", "b", "c", "d")], LOC)
    ent = spark.createDataFrame([(30, "S3", "B", 1, "p", True), (10, "S1", "B", 1, "q", True)], ENT)
    existing = spark.createDataFrame([], SUP)
    first = LD.load_suppliers(ent, loc, existing)
    assert sorted(r.supplier_id for r in first["inserted"].collect()) == [1, 2]
    again = LD.load_suppliers(ent, loc, first["target"])
    assert again["inserted"].count() == 0  # numbering of an empty frame


def test_order_name_join_fans_out(spark):
    batches = spark.createDataFrame(
        [(1, 1714521600, 7, "USD 10.00", True), (2, 1714521600123, 8, "USD 20.00", True)],
        "batch_id int, batch_date long, reference_id int, total_value string, is_valid boolean",
    )
    entities = spark.createDataFrame([(7, "Twin"), (8, "Solo")], "entity_id int, entity_label string")
    customers = spark.createDataFrame([("TAAAA", "Twin"), ("TBBBB", "Twin"), ("SCCCC", "Solo")], "customer_id string, company_name string")
    out = LD.load_orders(batches, entities, customers)["inserted"]
    got = sorted((r.batch_id, r.customer_id, r.order_id) for r in out.collect())
    # batch 1 matches two customers of one name: two orders (ids in batch, customer order)
    assert got == [(1, "TAAAA", 1), (1, "TBBBB", 2), (2, "SCCCC", 3)]
    assert {r.order_date for r in out.collect()} == {dt.datetime(2024, 5, 1)}


def test_every_valid_batch_and_line_is_accounted_for(spark):
    src = fx.sources(spark, SF_SMALL)
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    out = migrate(spark, src, targets, MigrationOptions())
    ids = lambda df, c: {r[0] for r in df.select(c).collect()}
    valid = ids(out["validated_batches"].filter("is_valid"), "batch_id")
    loaded, held, lost = (ids(out[n], "batch_id") for n in ("orders_inserted", "orders_quarantined", "orders_unmatched"))
    assert valid == loaded | held | lost and not loaded & lost and not held & lost and lost
    lines = ids(out["validated_transactions"].filter("is_valid"), "transaction_id")
    in_order, without = ids(out["order_detail_lineage"], "transaction_id"), ids(out["lines_unmatched"], "transaction_id")
    assert lines == in_order | without and not in_order & without


def test_reason_of_an_unmatched_batch(spark):
    loc = spark.createDataFrame([(1, "a", "b", "c", "d")], LOC)
    ent = spark.createDataFrame(
        [(1, "Known", "A", 1, "p", True), (2, "Clash", "A", 1, "p", True), (3, "Far", "A", 9, "p", True), (4, "Maker", "B", 1, "p", True), (5, " ", None, 1, "p", True)], ENT
    )
    customers = spark.createDataFrame([("K0000", "Known")], "customer_id string, company_name string")
    batches = spark.createDataFrame([(10 * i, i, True) for i in range(1, 6)] + [(99, None, False)], "batch_id int, reference_id int, is_valid boolean")
    got = {r.batch_id: r.reason for r in LD.orders_unmatched(batches, ent, loc, customers).collect()}
    assert got == {20: "CODE_CLASH", 30: "NO_ADDRESS", 40: "NOT_A_CUSTOMER", 50: "NO_NAME"}


def test_code_of_an_existing_customer(spark):
    """A new entity whose code belongs to a customer of another name isn't inserted, and is listed."""
    from handover.functions.scalars import customer_code

    ent = spark.createDataFrame(
        [(1, "Alpha", "A", 1, "p"), (2, "Beta", "A", 1, "p"), (3, "Gamma", "A", 1, "p")], "entity_id long, entity_label string, type_flag string, location_ref int, contact_info string"
    )
    loc = spark.createDataFrame([(1, "s", "m", "r", "z")], "location_id int, street_addr string, municipality string, region_code string, postal_code string")
    codes = {r["entity_label"]: r["c"] for r in ent.select("entity_label", customer_code("entity_label").alias("c")).collect()}
    cols = ["customer_id", "company_name", "contact_name", "phone", "address", "city", "region", "postal_code", "country"]
    rows = [(codes["Alpha"], "Other", *[None] * 7), (codes["Beta"], "Beta", *[None] * 7)]
    existing = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    out = LD.load_customers(ent, loc, existing)
    assert [tuple(r) for r in out["clashes"].collect()] == [(1, codes["Alpha"], "Alpha", "Other")]
    assert [r["entity_id"] for r in out["inserted"].collect()] == [3] and out["collisions"].count() == 0
