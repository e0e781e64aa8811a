"""Runs at the same time: one commit for a run id, no key twice."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from handover.operators.keys import with_row_index
from handover.plans.migration import MigrationOptions, run_migration
from handover.session import scratch_path
from handover.sinks.keyranges import reservations, reserve
from handover.sinks.publish import RunCommittedError, completed_runs, publish_run, read_published
from handover.sources import fixtures as fx

TS = dt.datetime(2024, 5, 1)


def _at_once(jobs):
    results = [None] * len(jobs)

    def run(i):
        try:
            results[i] = jobs[i]()
        except Exception as e:  # kept for the test
            results[i] = e

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(jobs))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return results


def test_of_two_attempts_at_one_run_one_is_seen(spark):
    root = scratch_path(spark, "publish")
    jobs = [lambda i=i: publish_run(spark, {"t": spark.range(100 * (i + 1))}, root, "r1", TS) for i in range(4)]
    results = _at_once(jobs)
    won = [i for i, r in enumerate(results) if isinstance(r, dict)]
    assert len(won) == 1 and all(isinstance(r, RunCommittedError) for i, r in enumerate(results) if i not in won)
    assert read_published(spark, root, "t").count() == 100 * (won[0] + 1)
    assert [r.run_id for r in completed_runs(spark, root).collect()] == ["r1"]


def test_reserved_ranges_dont_overlap(spark):
    root = scratch_path(spark, "publish")
    starts = _at_once([lambda n=n: reserve(spark, root, "orders", n, 11) for n in (5, 1, 300, 40, 7, 7)])
    taken = sorted(zip(starts, (5, 1, 300, 40, 7, 7)))
    assert taken[0][0] == 11
    assert all(a + n == b for (a, n), (b, _) in zip(taken, taken[1:]))
    assert reservations(spark, root, "orders")[-1][1] == 11 + 360 - 1
    assert reserve(spark, root, "orders", 3, 10**6) == 10**6  # the target has larger keys already
    assert reserve(spark, root, "orders", 0, 5) == 5 and reserve(spark, root, "other", 1) == 1


def test_two_runs_share_no_key(spark):
    root = scratch_path(spark, "publish")
    src = fx.sources(spark, SF_SMALL)
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    run = lambda i: run_migration(spark, src, targets, root, f"r{i}", MigrationOptions(as_of=TS, split_heavy=bool(i)))
    results = _at_once([lambda i=i: run(i) for i in range(2)])
    assert not any(isinstance(r, Exception) for r in results), results
    for table, key in (("suppliers", "supplier_id"), ("products", "product_id"), ("orders", "order_id")):
        rows = read_published(spark, root, f"{table}_inserted")
        assert rows.groupBy(key).count().where("count > 1").count() == 0
        assert rows.select("run_id").distinct().count() == 2
    # both runs load the same rows, whatever keys they took; split joins change nothing
    lines = read_published(spark, root, "order_details_inserted").join(
        read_published(spark, root, "orders_inserted").select("run_id", "order_id", "batch_id"), ["run_id", "order_id"]
    ).join(read_published(spark, root, "products_inserted").select("run_id", "product_id", "item_id"), ["run_id", "product_id"])
    a, b = (lines.where(F.col("run_id") == r).select("batch_id", "item_id", "quantity", "unit_price") for r in ("r0", "r1"))
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_a_failed_attempt_may_be_repeated(spark):
    root = scratch_path(spark, "publish")
    bad = spark.createDataFrame([("x",)], "s string").selectExpr("cast(s as int) as v")
    with pytest.raises(Exception):
        publish_run(spark, {"t": spark.range(3), "u": bad}, root, "r1", TS)
    assert publish_run(spark, {"t": spark.range(4), "u": spark.range(1)}, root, "r1", TS) == {"t": 4, "u": 1}
    assert read_published(spark, root, "t", "r1").count() == 4
    assert read_published(spark, root, "t", "r2").count() == 0
    with pytest.raises(ValueError):
        publish_run(spark, {"t": spark.range(3)}, root, "a/b", TS)


def test_numbering_asks_for_its_start(spark):
    seen = []
    df = with_row_index(spark.range(50).repartition(4), ["id"], "k", lambda n: seen.append(n) or 1000)
    assert seen == [50]
    assert df.where("k <> id + 1000").count() == 0


def test_ids_beyond_31_bits_pass_a_run(spark):
    big = 2**31 + 5
    src = fx.sources(spark, SF_SMALL)
    moved = {
        "locations": src["locations"],
        "entities": src["entities"],
        "items": src["items"].withColumn("item_id", F.col("item_id") + big),
        "batches": src["batches"].withColumn("batch_id", F.col("batch_id") + big),
        "transactions": src["transactions"].withColumns({c: F.col(c) + big for c in ("transaction_id", "batch_ref", "item_ref")}),
    }
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    small, large = scratch_path(spark, "publish"), scratch_path(spark, "publish")
    run_migration(spark, src, targets, small, "r", MigrationOptions(as_of=TS))
    run_migration(spark, moved, targets, large, "r", MigrationOptions(as_of=TS))
    for t in ("orders_inserted", "products_inserted", "order_details_inserted", "order_detail_lineage"):
        n = read_published(spark, small, t).count()
        assert read_published(spark, large, t).count() == n > 0
    assert read_published(spark, large, "orders_inserted").agg(F.min("batch_id")).first()[0] > big


def test_reports_on_published_tables(spark, tmp_path):
    from handover.__main__ import main

    root, tables, out = scratch_path(spark, "publish"), str(tmp_path / "tables"), str(tmp_path / "out")
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    run_migration(spark, fx.sources(spark, SF_SMALL), targets, root, "r", MigrationOptions(as_of=TS))
    none = spark.range(0)
    empty = {
        "orders": "cast(id as bigint) order_id, '' customer_id, cast(null as timestamp_ntz) order_date",
        "order_details": "cast(id as bigint) order_id, id product_id, id quantity, cast(id as decimal(19,4)) unit_price, cast(id as double) discount",
        "products": "id product_id, '' product_name, id category_id",
        "categories": "id category_id, '' category_name",
    }
    for t, cols in empty.items():
        none.selectExpr(*_split(cols)).write.parquet(f"{tables}/{t}")
    targets["customers"].write.parquet(f"{tables}/customers")
    assert main(["loyal-report", "--tables", tables, "--root", root, "--as-of", "2024-06-01", "--min-orders", "1", "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
    report = ["purchase-report", "--tables", tables, "--root", root, "--start", "2018-01-01", "--end", "2030-01-01", "--labels", "--out", out]
    assert main(report) == 0
    assert spark.read.parquet(out).count() == 0  # migrated products have no category


def _split(cols):
    out, depth, part = [], 0, ""
    for ch in cols:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(part)
            part = ""
        else:
            part += ch
    return [*out, part]


def test_audit_and_shift_commands(spark, tmp_path):
    from handover.__main__ import main

    before, after, out = (str(tmp_path / n) for n in ("b", "a", "o"))
    b, a = fx.product_snapshots(spark, SF_SMALL)
    b.write.parquet(before)
    a.write.parquet(after)
    assert main(["audit", "--before", before, "--after", after, "--key", "p_partkey", "--table", "Products", "--changed-by", "me", "--out", out]) == 0
    log, values = (spark.read.parquet(f"{out}/{n}") for n in ("log", "log_values"))
    assert log.count() == values.count() == log.join(values, "log_id").count() > 0
    dated, moved = str(tmp_path / "d"), str(tmp_path / "m")
    spark.sql("select timestamp_ntz'2024-02-29 05:00:00' as d, 1 as x").write.parquet(dated)
    assert main(["shift-dates", "--input", dated, "--column", "d", "--years", "1", "--out", moved]) == 0
    assert spark.read.parquet(moved).first()["d"] == dt.datetime(2025, 2, 28, 5)
