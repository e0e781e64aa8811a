"""A keyed table in files by key range, of which an update rewrites the ranges it changes.

Parquet has no UPDATE: a new version of a table writes all of it. Here rows lie
in folders by ``key div width``. An update compares the compared columns by key,
and writes anew (dynamic partition overwrite) the folders in which a row differs
or is new; all other files stay as they are. Spark puts a folder's new files in
place when the whole write has ended, so a lost executor leaves the old ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handover.operators.sizing import measured

RANGE = "key_range"


@dataclass
class RangedTable:
    """``width`` keys a folder: chosen so that a folder holds a file or a few."""

    spark: SparkSession
    path: str
    key: str
    width: int

    def _ranged(self, df: DataFrame) -> DataFrame:
        key = F.col(f"`{self.key}`").cast("long")
        return df.withColumn(RANGE, F.coalesce(F.floor(key / F.lit(self.width)).cast("long"), F.lit(-1)))

    def create(self, df: DataFrame) -> None:
        """Write the whole table. Keys are unique; a null key isn't allowed."""
        ranged = self._ranged(df)
        # one range goes to one task, which writes one file of it
        ranged.repartition(RANGE).sortWithinPartitions(RANGE, self.key).write.partitionBy(RANGE).parquet(self.path)

    def read(self) -> DataFrame:
        return self._read().drop(RANGE)

    def _read(self) -> DataFrame:
        df = self.spark.read.parquet(self.path)
        return df.withColumn(RANGE, F.col(RANGE).cast("long"))

    def update(self, rows: DataFrame, compare: list[str]) -> int:
        """Put ``rows`` (the table's columns) in the place of the rows of their keys; returns the number of ranges written.

        A range is written if one of its rows differs in a ``compare`` column or
        has a new key. Rows whose key isn't given stay.
        """
        old, new = self._read(), self._ranged(rows)
        was = old.select(F.col(self.key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in compare), F.lit(True).alias("__there"))
        both = new.join(was, new[self.key] == was["__key"], "left")
        same = reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(f"__{c}")), compare, F.col("__there").isNotNull())
        touched = measured(both.where(~same).select(RANGE).distinct(), "touched-ranges")
        n = touched.count()
        if n:
            fresh = new.join(touched, RANGE, "left_semi")
            kept = old.join(touched, RANGE, "left_semi").join(new.select(self.key), self.key, "left_anti")
            # written aside first: the ranges' own files are read for the rows that stay
            whole = measured(fresh.unionByName(kept.select(*fresh.columns)), "new-ranges")
            ranged = whole.repartition(RANGE).sortWithinPartitions(RANGE, self.key)
            ranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE).parquet(self.path)
        return n
