"""Log and LogValues tables of the stream: exactly once, whatever is run again."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from handover.operators import audit as A
from handover.session import scratch_path
from handover.sinks.marker import names, put_once, text_of
from handover.sources import fixtures as fx
from handover.streaming import log_tables as L

TS = dt.datetime(2024, 5, 1)


def _feeds(spark):
    customers = fx.customer_change_feed(spark, SF_SMALL, TS, "me")
    products = fx.product_change_feed(spark, SF_SMALL, TS, "me")
    return {"Customers": (customers, ["c_custkey"]), "Products": (products, ["p_partkey"])}


def _landed(spark, feeds, part):
    """A stream over the feeds' rows that are in ``part``; more rows may land later."""
    out, paths = {}, {}
    for name, (feed, keys) in feeds.items():
        paths[name] = scratch_path(spark, f"feed-{name}")
        feed.where(part).coalesce(1).write.parquet(paths[name])
        out[name] = (spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(paths[name]), keys)
    return out, paths


def _drain(streams, root, checkpoint):
    q = L.start_log_stream(streams, root, checkpoint)
    q.awaitTermination()
    assert q.exception() is None


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_both_tables_hold_each_change_once(spark):
    feeds = _feeds(spark)
    streams, paths = _landed(spark, feeds, "seq % 2 = 0")
    root, ckpt = scratch_path(spark, "tables"), scratch_path(spark, "ckpt")
    _drain(streams, root, ckpt)
    for name, (feed, _) in feeds.items():  # more files; the job starts again from its checkpoint
        feed.where("seq % 2 = 1").coalesce(1).write.mode("append").parquet(paths[name])
    _drain(streams, root, ckpt)
    log, values = L.read_log(spark, root)
    assert log.columns == A.LOG_COLS and values.columns == A.VALUES_COLS
    want = L.log_rows(feeds)
    got = log.join(values, "log_id").select("table_name", "operation", "key_values", "old_values", "new_values")
    assert _rows(got) == _rows(want.select(got.columns))
    assert log.select("log_id").distinct().count() == log.count() == values.count()
    assert len(L.committed(spark, root)) > 1


def test_a_batch_written_again_gives_equal_tables(spark):
    rows = L.log_rows(_feeds(spark)).repartition(3)
    root, other = scratch_path(spark, "tables"), scratch_path(spark, "tables")
    assert L.write_batch(rows, 7, root)
    once = [_rows(t) for t in L.read_log(spark, root)]
    assert not L.write_batch(rows.limit(3), 7, root)  # committed: left as it is
    assert [_rows(t) for t in L.read_log(spark, root)] == once
    # stopped between the two tables: nothing is seen, and the next attempt replaces what was written
    log, _ = A.split_log(rows.limit(5).withColumn("log_id", F.lit(1).cast("long")))
    log.write.parquet(f"{other}/log/batch_id=7")
    assert [t.count() for t in L.read_log(spark, other)] == [0, 0]
    assert L.write_batch(rows.repartition(5), 7, other)
    assert [_rows(t) for t in L.read_log(spark, other)] == once


def test_a_stream_stopped_after_its_commit_doesnt_write_twice(spark, monkeypatch):
    """The batch is committed to the tables, but the stream ends before it notes that."""
    feeds = _feeds(spark)
    streams, _ = _landed(spark, feeds, "true")
    root, ckpt = scratch_path(spark, "tables"), scratch_path(spark, "ckpt")
    write = L.write_batch

    def stops(rows, batch_id, where):
        write(rows, batch_id, where)
        raise RuntimeError("stopped")

    monkeypatch.setattr(L, "write_batch", stops)
    q = L.start_log_stream(streams, root, ckpt)
    with pytest.raises(Exception):
        q.awaitTermination()
    seen = [_rows(t) for t in L.read_log(spark, root)]
    monkeypatch.setattr(L, "write_batch", write)
    _drain(streams, root, ckpt)
    assert [_rows(t) for t in L.read_log(spark, root)] == seen
    assert len(seen[0]) == sum(f.count() for f, _ in feeds.values())


def test_no_batch_no_rows(spark):
    assert [t.count() for t in L.read_log(spark, scratch_path(spark, "tables"))] == [0, 0]


def test_a_marker_has_one_writer(spark):
    path = scratch_path(spark, "markers") + "/m"
    won = []
    threads = [threading.Thread(target=lambda i=i: put_once(spark, path, str(i)) and won.append(i)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and text_of(spark, path) == str(won[0])
    assert names(spark, path.rsplit("/", 1)[0]) == ["m"]
    assert names(spark, path + "-none") == [] and text_of(spark, path + "-none") is None


def test_inserts_of_a_run_are_logged(spark):
    rows = spark.createDataFrame([("B", "x", None), ("A", "y", 1)], "customer_id string, company_name string, n int")
    got = {r["key_values"]: r for r in A.with_log_ids(A.audit_inserts(rows, ["customer_id"], "Customers", TS, "me"), ["key_values"]).collect()}
    assert got['{"customer_id":"A"}']["log_id"] == 1 and got['{"customer_id":"B"}']["log_id"] == 2
    assert got['{"customer_id":"B"}']["new_values"] == '{"customer_id":"B","company_name":"x"}'
    assert {(r["operation"], r["old_values"]) for r in got.values()} == {("I", None)}
