import datetime as dt

from pyspark.sql import functions as F

from handover.operators import audit as A
from handover.sources import fixtures as fx
from handover.streaming.audit_stream import run_audit_stream
from conftest import SF_SMALL

TS = dt.datetime(2024, 5, 1)


def test_diff_operations(spark):
    before = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None), (3, 1, "c")], "k1 int, k2 int, v string")
    after = spark.createDataFrame([(1, 1, "a"), (1, 2, "B"), (2, 1, "x"), (4, 1, "d")], "k1 int, k2 int, v string")
    got = {(r.k1, r.k2): (r.operation, r.old_values, r.new_values, r.key_values)
           for r in A.audit_diff(before, after, ["k1", "k2"], "T", TS, "me").collect()}
    assert set(got) == {(1, 2), (2, 1), (3, 1), (4, 1)}  # (1,1) unchanged: not logged
    assert got[(1, 2)][0] == "U" and got[(1, 2)][3] == '{"k1":1,"k2":2}'
    assert got[(2, 1)][0] == "U" and got[(2, 1)][1] == '{"k1":2,"k2":1}'  # null fields left out
    assert got[(3, 1)][0] == "D" and got[(3, 1)][2] is None
    assert got[(4, 1)][0] == "I" and got[(4, 1)][1] is None


def test_log_split_and_counts(spark):
    before, after = fx.customer_snapshots(spark, "/root/testdata/sf0.01")
    changes = A.with_log_ids(A.audit_diff(before, after, ["c_custkey"], "Customers", TS, "me"), ["c_custkey"])
    counts = {r.operation: r["count"] for r in changes.groupBy("operation").count().collect()}
    assert counts == {"I": 150, "U": 150, "D": 150}
    log, values = A.split_log(changes)
    assert log.join(values, "log_id").count() == 450
    assert log.select("log_id").distinct().count() == 450


def test_stream_equals_diff_plus_noop_updates(spark):
    feed = fx.customer_change_feed(spark, SF_SMALL, TS, "me")
    streamed = run_audit_stream(spark, feed, ["c_custkey"])
    before, after = fx.customer_snapshots(spark, SF_SMALL)
    diffed = A.audit_diff(before, after, ["c_custkey"], "Customers", TS, "me")
    cols = ["table_name", "operation", "key_values", "old_values", "new_values"]
    s = streamed.select(*cols)
    d = diffed.select(*cols)
    assert d.exceptAll(s).count() == 0           # every diff change is in the stream
    extra = s.exceptAll(d)                        # plus the no-op updates (keys %10 = 4)
    assert extra.filter(F.col("old_values") != F.col("new_values")).count() == 0
    assert extra.count() == feed.filter("op = 'U' AND before = after").count() > 0


def test_stream_restart_is_exactly_once(spark):
    from handover.session import scratch_path
    from handover.streaming.audit_stream import start_audit_stream

    feed = fx.customer_change_feed(spark, SF_SMALL, TS, "me")
    feed_path, sink, ckpt = (scratch_path(spark, n) for n in ("feed", "sink", "ckpt"))
    first, second = feed.filter("seq % 2 = 0"), feed.filter("seq % 2 = 1")
    first.repartition(3, "seq").write.parquet(feed_path)
    q = start_audit_stream(spark, feed_path, feed.schema, ["c_custkey"], sink, ckpt)
    q.awaitTermination()
    n_first = spark.read.parquet(sink).count()
    assert n_first == first.count()
    # new files arrive; the job restarts from its checkpoint (as after a failure)
    second.repartition(2, "seq").write.mode("append").parquet(feed_path)
    q = start_audit_stream(spark, feed_path, feed.schema, ["c_custkey"], sink, ckpt)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == feed.count()
    assert out.select("key_values", "operation").distinct().count() == feed.count()
