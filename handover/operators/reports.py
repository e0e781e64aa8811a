"""Reports on the order-system tables: loyal customers and purchases.

Tables (DataFrames): orders (order_id, customer_id, order_date), customers
(customer_id, company_name, contact_name), order_details (order_id,
product_id, quantity, unit_price, discount), products (product_id,
product_name, category_id), categories (category_id, category_name).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from handover.functions.scalars import int_div, ntz_lit, shift_years
from handover.operators.bitsets import bit_sets, sizes
from handover.sinks.publish import read_published

# The column labels the source reports show.
PURCHASE_REPORT_LABELS = {
    "customer_id": "Customer identifier",
    "company_name": "Company name",
    "contact_name": "Customer contact name",
    "order_id": "Order identifier",
    "order_date": "Order date",
    "product_name": "Product name",
    "quantity": "Quantity",
    "unit_price": "Item Unit price",
    "total_price": "Total price",
    "category_name": "Category name",
}
LOYAL_REPORT_LABELS = {
    "customer_id": "CustomerID",
    "company_name": "CompanyName",
    "avg_orders_per_month": "Average number of order per month",
    "distinct_products": "Distinct count of products ordered",
}


def with_display_labels(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Rename report columns to their display labels (a projection only)."""
    return df.select(*[F.col(c).alias(labels.get(c, c)) for c in df.columns])


def report_tables(spark: SparkSession, folder: str, root: str | None = None) -> dict[str, DataFrame]:
    """The five report tables from ``folder``, and with ``root`` the rows that committed runs added.

    The migration gives its lines no discount and its products no category (the
    purchase report leaves products without one out, as the source's does), its
    customers no contact.
    """
    base = {t: spark.read.parquet(f"{folder.rstrip('/')}/{t}") for t in ("orders", "customers", "order_details", "products", "categories")}
    if root is None:
        return base
    missing = {"order_details": {"discount": F.lit(0)}, "products": {"category_id": F.lit(None)}, "customers": {"contact_name": F.lit(None)}, "orders": {}}
    for table, fill in missing.items():
        added = read_published(spark, root, f"{table}_inserted").withColumns(fill) if fill else read_published(spark, root, f"{table}_inserted")
        schema = base[table].schema
        wanted = [f for f in schema.fields if f.name in added.columns]
        added = added.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted))
        base[table] = base[table].unionByName(added, allowMissingColumns=True)
    return base


def _window(orders: DataFrame, as_of: dt.datetime, years: int = 1) -> DataFrame:
    """Orders dated in [as_of - years, as_of], bounds included (pushed to the scan)."""
    end = ntz_lit(as_of)
    return orders.filter(F.col("order_date").between(shift_years(end, -years), end))


def last_year_orders(orders: DataFrame, order_details: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per order line of the trailing year, one row for an order without lines."""
    o = _window(orders, as_of).select("order_id", "customer_id", "order_date")
    return o.join(order_details.select("order_id"), "order_id", "left").select("order_id", "customer_id", "order_date")


def _window_lines(orders: DataFrame, order_details: DataFrame, as_of: dt.datetime) -> DataFrame:
    o = _window(orders, as_of).select("order_id", "customer_id", "order_date")
    d = order_details.select("order_id", "product_id")
    return o.join(d, "order_id", "left")


def customers_with_orders(
    orders: DataFrame,
    order_details: DataFrame,
    customers: DataFrame,
    as_of: dt.datetime,
    min_orders: int = 5,
) -> DataFrame:
    """Customers with at least ``min_orders`` distinct orders (that have lines) in
    the trailing year, and their distinct product count.

    The source joins the line-level window to the lines a second time, which
    pairs every line of an order with every other; both distinct counts are
    unchanged by that. Orders and products are counted as bit sets
    (``operators.bitsets``) made in one pass over the lines, so no plan has a
    DISTINCT, and the sets add up across runs.
    """
    lines = _window_lines(orders, order_details, as_of).filter(F.col("product_id").isNotNull())
    counts = sizes(bit_sets(lines, ["customer_id"], "order_id", "product_id"), ["customer_id"], n_orders="order_id", distinct_product_count="product_id")
    return (
        counts.filter(F.col("n_orders") >= min_orders)
        .join(customers.select("customer_id", "company_name"), "customer_id")
        .select("customer_id", "company_name", "distinct_product_count")
    )


def customer_month_orders(
    orders: DataFrame,
    order_details: DataFrame,
    customers: DataFrame,
    as_of: dt.datetime,
    min_orders: int = 5,
    count_orders: bool = False,
) -> DataFrame:
    """Rows of the trailing-year order lines per customer and month, for the
    customers of ``customers_with_orders``. As in the source this counts
    lines (an order without lines counts once); ``count_orders`` counts
    distinct orders instead.

    One pass over the window's lines: they are reduced to one row per order,
    then per (customer, month) with the number of orders that have lines.
    Eligibility (at least ``min_orders`` such orders) is a sum over the
    customer's months -- a window whose groups hold at most 13 rows (the
    months an inclusive one-year window can touch), so a hot customer is
    still a small group.
    """
    lines = _window_lines(orders, order_details, as_of)
    per_order = lines.groupBy(
        "customer_id",
        "order_id",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
    ).agg(F.count("order_id").alias("n_rows"), F.count("product_id").alias("n_lines"))
    per_month = per_order.groupBy("customer_id", "order_year", "order_month").agg(
        F.sum("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_orders_month"),
        F.count(F.when(F.col("n_lines") > 0, F.lit(1))).alias("n_with_lines"),
    )
    counted = F.col("n_orders_month") if count_orders else F.col("n_rows")
    return (
        per_month.withColumn("n_orders", F.sum("n_with_lines").over(Window.partitionBy("customer_id")))
        .filter(F.col("n_orders") >= min_orders)
        .join(customers.select("customer_id"), "customer_id", "left_semi")
        .select("customer_id", "order_year", "order_month", counted.alias("order_count"))
    )


def loyal_customers(
    orders: DataFrame,
    order_details: DataFrame,
    customers: DataFrame,
    as_of: dt.datetime,
    min_orders: int = 5,
    count_orders: bool = False,
) -> DataFrame:
    """Per loyal customer: integer average of monthly counts over months with
    orders, and the distinct products ordered.

    The source chains four steps (window, customers with >= 5 orders, monthly
    counts, average). The average of the monthly counts over the active months
    is (all counted rows) div (number of active months), so the whole report
    is one join and one pass over the window's lines, which makes the customer's
    bit sets of orders, of orders with lines, of months and of products.
    """
    lines = _window_lines(orders, order_details, as_of)
    lines = lines.withColumns({"month": F.year("order_date") * 12 + F.month("order_date"), "with_lines": F.when(F.col("product_id").isNotNull(), F.col("order_id"))})
    sets = bit_sets(lines, ["customer_id"], "with_lines", "month", "product_id", *(["order_id"] if count_orders else []))
    counts = sizes(sets, ["customer_id"], {"n_rows": "month"}, n_orders="with_lines", n_months="month", distinct_products="product_id", n_all_orders="order_id")
    counted = F.col("n_all_orders") if count_orders else F.col("n_rows")
    return (
        counts.filter(F.col("n_orders") >= min_orders)
        .join(customers.select("customer_id", "company_name"), "customer_id")
        .select("customer_id", "company_name", int_div(counted, F.col("n_months")).alias("avg_orders_per_month"), "distinct_products")
    )


class ReportParameterError(ValueError):
    pass


def customer_purchase_report(
    tables: dict[str, DataFrame],
    start: dt.datetime | None,
    end: dt.datetime | None,
    category: str | None = None,
    sort: bool = True,
) -> DataFrame:
    """Purchases between ``start`` and ``end`` (inclusive), optionally of one
    category, ordered by order date and company name.

    Parameters are checked before any plan is built. The category filter is
    added only when given, so it stays a plain pushed-down predicate.
    """
    if start is None or end is None:
        raise ReportParameterError("start and end dates are required")
    if start > end:
        raise ReportParameterError("start date is after end date")
    o = tables["orders"].filter(F.col("order_date").between(ntz_lit(start), ntz_lit(end)))
    cat = tables["categories"]
    if category is not None:
        cat = cat.filter(F.col("category_name") == F.lit(category))
    # Inner joins in selectivity order (Catalyst keeps the written order
    # without statistics): the date window cuts the lines first, the category
    # the products next, and customers are joined last, on the rows left.
    df = (
        o.join(tables["order_details"], "order_id", "inner")
        .join(tables["products"], "product_id", "inner")
        .join(cat, "category_id", "inner")
        .join(tables["customers"], "customer_id", "inner")
        .select(
            "customer_id",
            "company_name",
            "contact_name",
            "order_id",
            "order_date",
            "product_name",
            "quantity",
            "unit_price",
            (F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount"))).alias("total_price"),
            "category_name",
        )
    )
    return df.orderBy("order_date", "company_name") if sort else df
