"""The audit's Log and LogValues tables, written by a stream.

Change feeds of several tables are mapped to log rows and united into one
stream. Each micro-batch is numbered and written to two tables, partitioned by
batch; a marker file made once commits it. A batch that a restarted stream runs
again is skipped if it was committed, and replaced as a whole if it wasn't, so
every change is logged once. Readers see committed batches only.

``log_id`` is the batch id and the row's number in the batch's own order, so a
batch written twice has the same ids, two batches share none, and no step looks
at the ids given so far. Ids grow with the batches but aren't dense.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.operators.audit import LOG_COLS, VALUES_COLS, audit_from_feed, split_log
from handover.operators.keys import with_row_index
from handover.sinks.marker import names, put_once

LOG, LOG_VALUES, COMMITS = "log", "log_values", "_batches"
ROW_BITS = 40  # of a log id: 2 ** 40 rows in a batch, 2 ** 23 batches
#: Total order of a batch's rows; rows equal in all of these are alike.
ORDER = ["table_name", "seq", "operation", "key_values", "old_values", "new_values", "change_date", "changed_by"]


def log_rows(feeds: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Log rows (with ``seq``, the place in the feed) of all feeds: table name -> (feed, key columns).

    The feeds may have rows of different types; they meet as JSON images.
    """
    parts = []
    for feed, keys in feeds.values():
        rows = audit_from_feed(feed, keys, "seq")
        parts.append(rows.select(*(c for c in ORDER)))
    return reduce(DataFrame.unionByName, parts)


def write_batch(rows: DataFrame, batch_id: int, root: str) -> bool:
    """Write one batch to both tables and commit it; False if it was committed before."""
    spark, root = rows.sparkSession, root.rstrip("/")
    if batch_id in committed(spark, root):
        return False
    # numbered in a written copy: both tables have the same ids
    numbered = with_row_index(rows, ORDER, "row")
    numbered = numbered.withColumn("log_id", F.lit(batch_id << ROW_BITS).cast("long") + F.col("row"))
    for name, part in zip((LOG, LOG_VALUES), split_log(numbered)):
        part.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
    return put_once(spark, f"{root}/{COMMITS}/{batch_id}")


def committed(spark: SparkSession, root: str) -> list[int]:
    """Ids of the committed batches."""
    return sorted(int(n) for n in names(spark, f"{root.rstrip('/')}/{COMMITS}"))


def start_log_stream(feeds: dict[str, tuple[DataFrame, list[str]]], root: str, checkpoint_path: str, available_now: bool = True):
    """Start the stream over streaming feeds. Several files go into a batch; the source's options may bound it."""
    writer = (
        log_rows(feeds)
        .writeStream.foreachBatch(lambda rows, batch_id: write_batch(rows, batch_id, root) and None)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def read_log(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The Log and LogValues tables: rows of committed batches."""
    root = root.rstrip("/")
    out = []
    ids = committed(spark, root)
    for name, cols in ((LOG, LOG_COLS), (LOG_VALUES, VALUES_COLS)):
        paths = [f"{root}/{name}/batch_id={i}" for i in ids]
        out.append(spark.read.option("basePath", f"{root}/{name}").parquet(*paths).select(*cols) if paths else spark.createDataFrame([], _SCHEMAS[name]))
    return tuple(out)


_SCHEMAS = {
    LOG: "log_id long, table_name string, operation string, key_values string, change_date timestamp_ntz, changed_by string",
    LOG_VALUES: "log_values_id long, log_id long, old_values string, new_values string",
}
