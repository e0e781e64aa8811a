import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from handover.sinks.publish import publish_run, read_published, write_table


def test_publish_and_read(spark):
    root = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    publish_run(spark, {"t": a}, root, "r1", dt.datetime(2024, 5, 1))
    assert read_published(spark, root, "t").count() == 2
    # a half-written run (table written, no marker) stays invisible
    write_table(spark.createDataFrame([(3,)], "x int"), root, "t", "r2")
    assert sorted(r.x for r in read_published(spark, root, "t").collect()) == [1, 2]
    publish_run(spark, {"t": spark.createDataFrame([(3,)], "x int")}, root, "r2", dt.datetime(2024, 5, 2))
    assert read_published(spark, root, "t").count() == 3
    assert read_published(spark, root, "t", "r2").count() == 1


def test_publish_failure_leaves_nothing(spark):
    root = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    bad = spark.createDataFrame([("x",)], "s string").selectExpr("cast(s as int) as v")  # ANSI cast fails
    with pytest.raises(Exception):
        publish_run(spark, {"ok": spark.range(3), "bad": bad}, root, "r1", dt.datetime(2024, 5, 1))
    assert read_published(spark, root, "ok").count() == 0  # written, never committed


def test_committed_run_is_not_replaced(spark):
    root = tempfile.mkdtemp(prefix="pub-", dir="/tmp")
    publish_run(spark, {"t": spark.range(3)}, root, "r1", dt.datetime(2024, 5, 1))
    with pytest.raises(ValueError):
        publish_run(spark, {"t": spark.range(7)}, root, "r1", dt.datetime(2024, 5, 1))
    assert read_published(spark, root, "t").count() == 3


def test_run_migration_publishes_each_table_once(spark):
    from handover.plans.migration import MigrationOptions, run_migration
    from handover.sources import fixtures as fx
    from conftest import SF_SMALL

    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    src = fx.sources(spark, SF_SMALL)
    targets = {"customers": fx.existing_customers(spark, SF_SMALL), "suppliers": fx.existing_suppliers(spark, SF_SMALL)}
    out = run_migration(spark, src, targets, root, "r1", MigrationOptions())
    # keyed and validated tables were written in place (their read-back is the published copy)
    assert {"validated_transactions", "orders_inserted", "products_inserted"} <= set(out.written)
    log = {r.table_name: r.row_count for r in spark.read.parquet(f"{root}/_run_log").collect()}
    for name in ["orders_inserted", "order_details_inserted", "insert_log", "validated_transactions"]:
        assert read_published(spark, root, name, "r1").count() == log[name] > 0
    lines = read_published(spark, root, "order_details_inserted", "r1")
    orders = read_published(spark, root, "orders_inserted", "r1")
    assert lines.join(orders, "order_id", "left_anti").count() == 0


def test_constraint_modes_of_a_run(spark):
    from handover.operators.quality import ConstraintViolation
    from handover.plans.migration import check_sources
    from handover.sources import fixtures as fx
    from conftest import SF_SMALL

    loc = fx.sources(spark, SF_SMALL)["locations"]
    twice = loc.orderBy("location_id").limit(1)
    nameless = twice.withColumn("location_id", F.lit(None).cast(loc.schema["location_id"].dataType))
    src = {"locations": loc.unionByName(twice).unionByName(nameless)}
    same, about = check_sources(src, "report")
    assert same is src and about["source_violations"].where("table_name = 'locations' and rule like '%KEY%'").count() == 2
    with pytest.raises(ConstraintViolation):
        check_sources(src, "fail")
    clean, about = check_sources(src, "quarantine")
    assert about["quarantined_locations"].count() >= 3  # both copies and the null key
    assert clean["locations"].count() + about["quarantined_locations"].count() == src["locations"].count()
    assert clean["locations"].where("location_id is null").count() == 0
    with pytest.raises(ValueError):
        check_sources(src, "ignore")


def test_command_line(spark):
    from handover.__main__ import main
    from handover.sinks.publish import completed_runs
    from conftest import SF_SMALL

    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    assert main(["migrate", "--fixtures", SF_SMALL, "--root", root, "--run-id", "c1", "--as-of", "2024-05-01"]) == 0
    assert [r.run_id for r in completed_runs(spark, root).collect()] == ["c1"]
    out = tempfile.mkdtemp(prefix="cli-rep-", dir="/tmp") + "/rep"
    assert main(["purchase-report", "--fixtures", SF_SMALL, "--start", "1997-01-01", "--end", "1997-12-31", "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
