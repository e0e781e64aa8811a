"""Hot keys (a third of all rows in one group) against brute-force pandas."""

import datetime as dt
import random

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import functions as F

from handover.operators import validate as V
from handover.operators.load import load_order_details
from handover.operators.reports import customers_with_orders, loyal_customers

TXN = "transaction_id int, batch_ref int, item_ref int, partner_ref int, qty int, date_key long, amount string"


def _skewed_transactions(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        if i % 3 == 0:  # a third of the rows in one duplicate group
            rows.append((i, 1, 1, 0, rnd.randint(1, 9), 5, f"{rnd.randint(1, 99)}%"))
        else:
            item = None if i % 11 == 0 else rnd.randint(1, 40)
            rows.append((i, rnd.randint(1, 200), item, 0, rnd.randint(1, 9), rnd.randint(1, 3), rnd.choice(["10%", "bad%", "33.5%", "25%"])))
    return rows


def test_duplicates_with_hot_group(spark):
    rows = _skewed_transactions()
    t = spark.createDataFrame(rows, TXN)
    pdf = pd.DataFrame(rows, columns=[f.split()[0] for f in TXN.split(", ")])
    first = pdf.groupby(["batch_ref", "item_ref", "date_key"], dropna=False)["transaction_id"].transform("min")
    expected = set(pdf.loc[pdf.transaction_id != first, "transaction_id"])
    got = {r.transaction_id for r in V.duplicate_transactions(t).collect()}
    assert got == expected and len(got) >= 999


def test_order_lines_with_hot_batch(spark):
    rows = _skewed_transactions()
    t = spark.createDataFrame(rows, TXN).withColumn("is_valid", F.col("amount") != "bad%")  # as the cascade marks them
    items = spark.createDataFrame([(i, f"P{i % 7}") for i in range(1, 41)], "item_id int, label string")
    products = spark.createDataFrame([(100 + k, f"P{k}") for k in range(7)] + [(200, "P1")], "product_id long, product_name string")
    orders = spark.createDataFrame([(1000 + b, b, Decimal("500.00")) for b in range(1, 201)],
                                   "order_id long, batch_id int, total_value decimal(19,4)")
    got = {(r.order_id, r.product_id): (r.quantity, float(r.unit_price))
           for r in load_order_details(t, items, products, orders)["inserted"].collect()}
    # brute force over single transactions (no pre-aggregation)
    pdf = pd.DataFrame(rows, columns=[f.split()[0] for f in TXN.split(", ")])
    pdf = pdf[pdf.amount != "bad%"].dropna(subset=["item_ref"])
    pdf["pct"] = pdf.amount.str.rstrip("%").astype(float)
    pdf["label"] = pdf.item_ref.astype(int).map(lambda i: f"P{i % 7}")
    prod = pd.DataFrame([(100 + k, f"P{k}") for k in range(7)] + [(200, "P1")], columns=["product_id", "label"])
    j = pdf.merge(prod, on="label")
    g = j.groupby(["batch_ref", "product_id"]).agg(q=("qty", "sum"), p=("pct", "sum")).reset_index()
    def half_up(p, q):
        return float((Decimal(500) * Decimal(str(p)) / 100 / Decimal(int(q))).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))

    exp = {(1000 + r.batch_ref, r.product_id): (r.q, half_up(r.p, r.q)) for r in g.itertuples()}
    assert got == exp


def _expected_loyal(orders, lines, customers, as_of):
    """By the rule, in plain Python: five orders with lines; an order weighs its lines, or one without any."""
    names, baskets, by_customer = dict(customers), {}, {}
    for order, product in lines:
        baskets.setdefault(order, []).append(product)
    for order, customer, day in orders:
        if as_of.replace(year=as_of.year - 1) <= day <= as_of and customer in names:
            by_customer.setdefault(customer, []).append((day, baskets.get(order, [])))
    found = {}
    for customer, placed in by_customer.items():
        if sum(1 for _, basket in placed if basket) >= 5:
            weight = sum(max(1, len(basket)) for _, basket in placed)
            months = {(day.year, day.month) for day, _ in placed}
            found[customer, names[customer]] = (weight // len(months), len({x for _, basket in placed for x in basket}))
    return found


def test_loyal_report_with_hot_customer(spark):
    rnd = random.Random(11)
    as_of = dt.datetime(2001, 8, 1)
    orders, lines = [], []
    for oid in range(1, 901):
        cust = 1 if oid % 3 == 0 else rnd.randint(2, 60)   # one customer holds a third of the orders
        day = dt.datetime(2000, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        orders.append((oid, cust, day))
        for _ in range(rnd.choice([0, 1, 2, 4])):
            lines.append((oid, rnd.randint(1, 30)))
    customers = [(c, f"C{c}") for c in range(1, 55)]
    o = spark.createDataFrame(orders, "order_id long, customer_id long, order_date timestamp_ntz")
    d = spark.createDataFrame(lines, "order_id long, product_id long")
    c = spark.createDataFrame(customers, "customer_id long, company_name string")
    got = {(r.customer_id, r.company_name): (r.avg_orders_per_month, r.distinct_products)
           for r in loyal_customers(o, d, c, as_of).collect()}
    exp = _expected_loyal(orders, lines, customers, as_of)
    assert got == exp and (1, "C1") in got
    cwo = {r.customer_id for r in customers_with_orders(o, d, c, as_of).collect()}
    assert cwo == {k[0] for k in exp}
