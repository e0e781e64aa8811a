"""Give the planner a measured size for a side that is usually small.

Spark's static size estimate for an aggregated or joined subplan is an upper
bound that can be orders of magnitude too large, so it plans a shuffle join
even when that side turns out tiny (AQE can switch to a broadcast only after
the large side has already been shuffled). Writing the small side once to
the shared folder gives the planner its real size (file statistics): Spark
then broadcasts it only when it is under ``spark.sql.autoBroadcastJoinThreshold``
-- a size check backed by measurement -- and keeps the shuffle join beyond
that. The written copy also survives executor loss.

Every call writes a new copy: a copy kept for a plan of the same meaning would
go stale when the plan's input is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from handover.session import scratch_path


def measured(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)
