"""Change audit as a Structured Streaming job over a change feed.

The feed (op, before, after, change_date, changed_by, seq) lands as parquet
files; the job maps each record to a log row (stateless, so no watermark
or state store is needed) and appends to a parquet sink. The file sink
commits each micro-batch in its metadata log, so a batch replayed after a
failure is written exactly once; the checkpoint lives in the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from handover.operators.audit import audit_from_feed
from handover.session import scratch_path
from handover.streaming.log_tables import read_log, start_log_stream


def audit_stream(feed_stream: DataFrame, keys: list[str]) -> DataFrame:
    """The streaming transformation: feed records -> audit log rows."""
    return audit_from_feed(feed_stream, keys)


def start_audit_stream(
    spark: SparkSession,
    feed_path: str,
    feed_schema,
    keys: list[str],
    sink_path: str,
    checkpoint_path: str,
    files_per_trigger: int | None = None,
    available_now: bool = True,
):
    """Start the job: read new feed files, write log rows to ``sink_path``. A trigger
    takes all files that are there, or ``files_per_trigger`` at most."""
    reader = spark.readStream.schema(feed_schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(feed_path)
    writer = (
        audit_stream(stream, keys)
        .writeStream.format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_audit_stream(spark: SparkSession, feed: DataFrame, keys: list[str]) -> DataFrame:
    """Land ``feed`` as files, run the stream until the feed is drained, and
    return the sink as a DataFrame."""
    feed_path = scratch_path(spark, "audit-feed")
    feed.write.parquet(feed_path)
    sink = scratch_path(spark, "audit-log")
    ckpt = scratch_path(spark, "audit-ckpt")
    q = start_audit_stream(spark, feed_path, feed.schema, keys, sink, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink)


def run_log_stream(spark: SparkSession, feeds: dict[str, tuple[DataFrame, list[str]]]) -> tuple[DataFrame, DataFrame]:
    """Land the feeds (table name -> (feed, key columns)) as files, drain them by one
    stream and return the Log and LogValues tables."""
    streams = {}
    for name, (feed, keys) in feeds.items():
        path = scratch_path(spark, "audit-feed")
        feed.write.parquet(path)
        streams[name] = (spark.readStream.schema(feed.schema).parquet(path), keys)
    root = scratch_path(spark, "audit-tables")
    q = start_log_stream(streams, root, scratch_path(spark, "audit-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_log(spark, root)
