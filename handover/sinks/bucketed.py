"""A target table in hash buckets of its key, into which rows are merged without moving it.

The rows to insert are dealt by the same hash to the same number of buckets, so
finding those whose key is there needs no shuffle of the target, whatever its
size; and they are appended as further files of the same buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from handover.session import scratch_path


def create_target(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> None:
    """Write ``df`` as the bucketed table ``name`` of the session's catalog, under ``path`` (shared storage)."""
    path = path or scratch_path(df.sparkSession, name)
    # dealt like the buckets, so that each task writes one file of one bucket
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("errorifexists").saveAsTable(name)


def missing_rows(spark: SparkSession, name: str, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` whose key isn't in the table; null keys match nothing.

    The source is dealt to the table's buckets. The join is a merge or a hash
    join by bucket: the target is neither shuffled nor sent to all tasks.
    """
    target = spark.table(name).select(*keys).dropna()
    return source.repartition(_buckets(spark, name), *keys).join(target.hint("merge"), keys, "left_anti")


def insert_missing_rows(spark: SparkSession, name: str, source: DataFrame, keys: list[str]) -> int:
    """Append the rows of ``source`` whose key isn't in the table yet; returns their number.

    ``source`` has the table's columns; of rows with one key the first in the
    order of all columns is taken.
    """
    rest = [c for c in source.columns if c not in keys]
    new = missing_rows(spark, name, source, keys).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*")
    buckets, obs = _buckets(spark, name), Observation(f"inserted_{name}")
    new = new.select(*spark.table(name).columns).observe(obs, F.count(F.lit(1)).alias("rows"))
    new.write.mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return int(obs.get["rows"])


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])
