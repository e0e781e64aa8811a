"""Monthly states of the order reports: made once for each run, merged for any trailing year.

A state has two tables by customer and month: counts, which add up because an
order belongs to one run, and bit sets of the products ordered. A run's state
is written when the run's orders are; a report then reads the year's months of
all runs' states and, for the two months that the window cuts, the orders
themselves. The result is that of counting all orders and lines anew.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.functions.scalars import int_div, ntz_lit
from handover.operators.bitsets import bit_sets, merged, sizes
from handover.sinks.marker import names, put_once

COUNTS, PRODUCTS, COMMITS = "month_counts", "month_products", "_months"
_SUMS = ["n_rows", "n_orders", "n_with_lines"]


@dataclass
class MonthStates:
    counts: DataFrame  # customer_id, month (yyyymm), n_rows, n_orders, n_with_lines
    products: DataFrame  # customer_id, month and the bit sets' columns

    def where(self, condition: Column) -> MonthStates:
        return MonthStates(self.counts.where(condition), self.products.where(condition))


def month_of(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def month_states(orders: DataFrame, order_details: DataFrame) -> MonthStates:
    """The state of ``orders`` (order_id, customer_id, order_date) and their lines (order_id, product_id).

    ``n_rows`` counts lines, and an order without lines once; ``n_with_lines``
    the orders that have lines. An order of a table with repeated ids isn't one order.
    """
    o = orders.select("order_id", "customer_id", month_of(F.col("order_date")).alias("month"))
    lines = o.join(order_details.select("order_id", "product_id"), "order_id", "left")
    per_order = lines.groupBy("order_id", "customer_id", "month").agg(F.count(F.lit(1)).alias("rows"), F.count("product_id").alias("lines"))
    counts = per_order.groupBy("customer_id", "month").agg(
        F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_orders"), F.count(F.when(F.col("lines") > 0, 1)).alias("n_with_lines")
    )
    return MonthStates(counts, bit_sets(lines, ["customer_id", "month"], "product_id"))


def merge_states(states: list[MonthStates]) -> MonthStates:
    """One state of several runs' orders."""
    counts = reduce(DataFrame.unionByName, [s.counts for s in states])
    counts = counts.groupBy("customer_id", "month").agg(*(F.sum(c).alias(c) for c in _SUMS))
    return MonthStates(counts, merged([s.products for s in states], ["customer_id", "month"]))


def write_states(states: MonthStates, root: str, run_id: str) -> bool:
    """Add a run's state to the tables under ``root``; False if that run is there already."""
    spark, root = states.counts.sparkSession, root.rstrip("/")
    if run_id in names(spark, f"{root}/{COMMITS}"):
        return False
    for table, df in ((COUNTS, states.counts), (PRODUCTS, states.products)):
        df.write.mode("overwrite").partitionBy("month").parquet(f"{root}/{table}/run_id={run_id}")
    return put_once(spark, f"{root}/{COMMITS}/{run_id}")


def read_states(spark: SparkSession, root: str) -> MonthStates:
    """All committed runs' states; a condition on ``month`` prunes folders. Rows of different runs aren't merged yet."""
    root = root.rstrip("/")
    runs = names(spark, f"{root}/{COMMITS}")
    if not runs:
        raise ValueError(f"no run's state under {root}")
    read = lambda table: spark.read.option("basePath", f"{root}/{table}").parquet(*(f"{root}/{table}/run_id={r}" for r in runs)).drop("run_id")
    return MonthStates(read(COUNTS), read(PRODUCTS))


def _year_before(t: dt.datetime) -> dt.datetime:
    try:
        return t.replace(year=t.year - 1)
    except ValueError:  # 29 February
        return t.replace(year=t.year - 1, day=28)


def _next_month(t: dt.datetime) -> dt.datetime:
    return dt.datetime(t.year + t.month // 12, t.month % 12 + 1, 1)


def split_window(as_of: dt.datetime) -> tuple[dt.datetime, dt.datetime, dt.datetime, dt.datetime]:
    """(start, first, last, as_of): the trailing year, and the whole months [first, last) in it."""
    start = _year_before(as_of)
    first = dt.datetime(start.year, start.month, 1)
    first = first if first == start else _next_month(first)
    last = dt.datetime(as_of.year, as_of.month, 1)
    return start, first, last, as_of


def loyal_customers_from_months(
    states: MonthStates, orders: DataFrame, order_details: DataFrame, customers: DataFrame, as_of: dt.datetime, min_orders: int = 5, count_orders: bool = False
) -> DataFrame:
    """``reports.loyal_customers`` from monthly states.

    ``orders`` and ``order_details`` are read for the days before the first whole
    month and from the last month's first day on, at most two months.
    """
    start, first, last, end = split_window(as_of)
    date, month = F.col("order_date"), F.col("month")
    cut = orders.where(((date >= ntz_lit(start)) & (date < ntz_lit(first))) | ((date >= ntz_lit(last)) & (date <= ntz_lit(end))))
    number = lambda t: t.year * 100 + t.month
    whole = states.where((month >= number(first)) & (month < number(last)))
    year = merge_states([whole, month_states(cut, order_details)])
    counts = year.counts.groupBy("customer_id").agg(*(F.sum(c).alias(c) for c in _SUMS), F.count(F.lit(1)).alias("n_months")).where(F.col("n_with_lines") >= min_orders)
    # a customer's sets of the months are one set before its members are counted
    products = sizes(merged([year.products], ["customer_id"]), ["customer_id"], distinct_products="product_id")
    counted = F.col("n_orders") if count_orders else F.col("n_rows")
    return (
        counts.join(products, "customer_id")
        .join(customers.select("customer_id", "company_name"), "customer_id")
        .select("customer_id", "company_name", int_div(counted, F.col("n_months")).alias("avg_orders_per_month"), "distinct_products")
    )
