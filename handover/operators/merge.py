"""Insert-style merges for file tables (parquet has no MERGE/UPDATE)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.operators.keys import first_key, next_key_after, with_surrogate_key


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target`` (MERGE ... WHEN NOT MATCHED INSERT).

    A left anti join: Spark broadcasts the target when its measured size is
    under the broadcast threshold and sort-merges otherwise. Null keys never
    match, as in SQL.
    """
    return source.join(target.select(*keys).dropna(), keys, "left_anti")


def append_with_keys(
    target: DataFrame | None,
    source: DataFrame,
    key_col: str,
    order_cols: list[str | Column],
    reserve: Callable[[int, int], int] | None = None,
) -> DataFrame:
    """Always-insert merge: every source row gets a new key after the target's max.

    ``reserve(n, first)`` may move the keys beyond those that other runs have
    taken but not published yet.

    The source row keeps its own id columns, so source and target keys come
    out together without any merge trick.
    """
    start = next_key_after(target, key_col) if target is not None else F.lit(1).cast("long")
    if reserve is not None:
        first = first_key(source.sparkSession, start)
        return with_surrogate_key(source, order_cols, key_col, lambda n: reserve(n, first))
    return with_surrogate_key(source, order_cols, key_col, start)


def union_target(target: DataFrame, inserted: DataFrame) -> DataFrame:
    """The target table after the insert (same columns as ``target``)."""
    return target.unionByName(inserted.select(*target.columns))
