"""Intermediate tables in the shared folder (``spark.checkpoint.dir``): they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from handover.session import scratch_path


def write(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once and read again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame | None) -> None:
    """Delete a table made by ``write`` that nothing reads any more."""
    if df is None:
        return
    files = df.inputFiles()
    if files:
        _delete(df.sparkSession, files[0].rsplit("/", 1)[0])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most so many rows (reads no more than that)."""
    return df.limit(rows + 1).count() <= rows
