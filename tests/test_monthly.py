"""Bit sets and monthly states against plain counts."""

import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from handover.operators import reports as R
from handover.operators.bitsets import bit_sets, merged, sizes
from handover.operators.monthly import loyal_customers_from_months, merge_states, month_states, read_states, split_window, write_states
from handover.session import scratch_path
from handover.sources import fixtures as fx

IDS = [0, 1, 63, 64, 65, 127, 128, 10**12, 2**62, -1, -64, -65, None]


def test_bit_sets_count_distinct_members(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice(IDS)) for _ in range(400)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, m long").repartition(5)
    want = defaultdict(set)
    for g, m in rows:
        if m is not None:
            want[g].add(m)
    sets = bit_sets(df, ["g"], "m")
    got = {r["g"]: (r["n"], r["all"]) for r in sizes(sets, ["g"], {"all": "m"}, n="m").collect()}
    assert got == {g: (len(s), sum(x == g and m is not None for x, m in rows)) for g, s in want.items()}
    whole = sizes(merged([sets.where("g = 'a'"), sets.where("g is null or g <> 'a'")], []), [], n="m").first()["n"]
    assert whole == len(set().union(*want.values()))
    two = sizes(bit_sets(df.withColumn("h", F.lit(5)), ["g"], "m", "h"), ["g"], n="m", five="h").collect()
    assert {r["g"]: (r["n"], r["five"]) for r in two} == {g: (len(want.get(g, ())), 1) for g in ("a", "b", None, "none")}
    dense = spark.range(6400).select(F.lit(1).alias("g"), "id")
    assert bit_sets(dense, ["g"], "id").count() == 100


def _tables(spark):
    rng = random.Random(2)
    orders, lines = [], []
    for i in range(1, 900):
        day = dt.datetime(2000, 1, 15) + dt.timedelta(days=rng.randint(0, 500), hours=rng.choice([0, 0, 23]))
        orders.append((i, rng.randint(1, 25), day))
        lines += [(i, rng.randint(1, 90)) for _ in range(rng.randint(0, 4))]
    customers = [(c, f"c{c}", None) for c in range(1, 24)]
    return (
        spark.createDataFrame(orders, "order_id long, customer_id long, order_date timestamp_ntz"),
        spark.createDataFrame(lines, "order_id long, product_id long"),
        spark.createDataFrame(customers, "customer_id long, company_name string, contact_name string"),
    )


def _rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("count_orders", [False, True])
@pytest.mark.parametrize("as_of", [dt.datetime(2001, 2, 1), dt.datetime(2001, 3, 10, 12), dt.datetime(2001, 1, 31, 23), dt.datetime(2001, 5, 31)])
def test_states_of_runs_give_the_whole_count(spark, as_of, count_orders):
    orders, lines, customers = _tables(spark)
    parts = [month_states(orders.where(F.col("order_id") % 3 == i), lines) for i in range(3)]
    want = _rows(R.loyal_customers(orders, lines, customers, as_of, count_orders=count_orders))
    assert want
    got = loyal_customers_from_months(merge_states(parts), orders, lines, customers, as_of, count_orders=count_orders)
    assert _rows(got) == want


def test_a_run_adds_its_state_once(spark):
    orders, lines, customers = _tables(spark)
    root = scratch_path(spark, "months")
    with pytest.raises(ValueError):
        read_states(spark, root)
    even, odd = (month_states(orders.where(F.col("order_id") % 2 == i), lines) for i in (0, 1))
    assert write_states(even, root, "r1") and write_states(odd, root, "r2")
    assert not write_states(odd, root, "r2")
    odd.counts.write.partitionBy("month").parquet(f"{root}/month_counts/run_id=r3")  # stopped before its commit
    as_of = dt.datetime(2001, 3, 10)
    states = read_states(spark, root)
    assert _rows(loyal_customers_from_months(states, orders, lines, customers, as_of)) == _rows(R.loyal_customers(orders, lines, customers, as_of))
    plan = states.counts.where("month between 200003 and 200012")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan)


def test_whole_months_of_a_trailing_year():
    d = dt.datetime
    assert split_window(d(2001, 8, 1)) == (d(2000, 8, 1), d(2000, 8, 1), d(2001, 8, 1), d(2001, 8, 1))
    assert split_window(d(2001, 12, 31, 5))[:3] == (d(2000, 12, 31, 5), d(2001, 1, 1), d(2001, 12, 1))
    assert split_window(d(2024, 2, 29))[:3] == (d(2023, 2, 28), d(2023, 3, 1), d(2024, 2, 1))


def test_reports_copy_no_rows_for_distinct_counts(spark):
    t = fx.report_tables(spark, SF_SMALL)
    as_of = dt.datetime(2001, 8, 1)
    for df in (
        R.loyal_customers(t["orders"], t["order_details"], t["customers"], as_of),
        R.customers_with_orders(t["orders"], t["order_details"], t["customers"], as_of),
        month_states(t["orders"], t["order_details"]).products,
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "Distinct" not in plan
    lines = R._window_lines(t["orders"], t["order_details"], as_of)
    n = lines.count()
    assert bit_sets(lines, ["customer_id"], "product_id").count() <= lines.select("customer_id", "product_id").distinct().count() <= n
