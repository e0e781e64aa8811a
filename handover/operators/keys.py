"""Generated keys (IDENTITY columns) without a single-task global window.

``with_row_index`` numbers rows 1..n (plus an offset) in a total order:

1. range-partition on the order columns, sort inside each partition and tag
   each row with (partition, position) -- ``monotonically_increasing_id``;
2. write that frame once to the shared checkpoint folder and read it back:
   range bounds come from sampling, so two evaluations of the shuffle may
   cut the data differently; one written copy makes the counts and the
   positions agree, cuts the lineage, and survives executor loss;
3. count rows per partition (a tiny aggregate: one row per partition, so its
   size is bounded by the partition count, not by the data -- the way
   ``RDD.zipWithIndex`` computes its start indices) and turn the counts into
   cumulative offsets, held as one literal array;
4. key = start + offset of the partition + position inside the partition.

The result equals ``row_number() OVER (ORDER BY order_cols)`` when the
order columns are a total order; callers append a unique column to break
ties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.session import scratch_path

_PID = "__ho_pid"
_POS = "__ho_pos"
_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id << 33 | position


def _order_cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_row_index(
    df: DataFrame,
    order_cols: list[str | Column],
    name: str,
    start: int | Column | Callable[[int], int] = 1,
    num_partitions: int | None = None,
    group: int | None = None,
    add: dict[str, Column] | None = None,
) -> DataFrame:
    """Append ``name`` = start + (rank of the row in ``order_cols``) - 1.

    A function gets the number of rows and says where to start, e.g. by
    reserving as many keys (``sinks.keyranges``). ``group``: the ranges are cut
    on the first so many order columns, so rows that agree in them share a task;
    ``add``: window columns over these, found in the sorted ranges without a
    shuffle of their own."""
    spark = df.sparkSession
    order = _order_cols(order_cols)
    cut = order[:group]
    # Without a fixed count AQE may coalesce adjacent ranges to right-size the
    # tasks; merged partitions are still contiguous ranges in order, so the
    # numbering stays exact.
    ranged = df.repartitionByRange(num_partitions, *cut) if num_partitions else df.repartitionByRange(*cut)
    tagged = ranged.select("*", *(c.alias(n) for n, c in (add or {}).items())).sortWithinPartitions(*order).withColumn(_POS, F.monotonically_increasing_id())
    path = scratch_path(spark, "row-index")
    tagged.write.parquet(path)
    ranged = (
        spark.read.parquet(path)
        .withColumn(_PID, F.shiftright(F.col(_POS), _LOCAL_BITS))
        .withColumn(_POS, F.col(_POS).bitwiseAND((1 << _LOCAL_BITS) - 1))
    )
    if isinstance(start, Column):
        # Fixed once, at numbering time (like an IDENTITY seed): a later
        # change of the table the start came from must not move the keys.
        start = first_key(spark, start)
    # One row per partition: the size of this result is bounded by the
    # partition count, not by the data (as RDD.zipWithIndex does).
    sizes = {r[0]: r[1] for r in ranged.groupBy(_PID).count().collect()}
    acc, offsets = 0, []
    for pid in range(max(sizes, default=-1) + 1):
        offsets.append(acc)
        acc += sizes.get(pid, 0)
    start_col = F.lit(int(start(acc) if callable(start) else start)).cast("long")
    # A single folded literal, as long as the session's number of shuffle
    # partitions: the key is then a narrow projection, with no join, window or
    # shuffle in the plans that read it.
    table = F.split(F.lit(",".join(map(str, offsets)) or "0"), ",").cast("array<bigint>")
    off = F.element_at(table, (F.col(_PID) + 1).cast("int"))
    return ranged.withColumn(name, (start_col + off + F.col(_POS)).cast("long")).drop(_PID, _POS)


def first_key(spark, start: Column) -> int:
    return spark.range(1).select(start.alias("s")).first()["s"]


def with_surrogate_key(
    df: DataFrame,
    order_cols: list[str | Column],
    name: str,
    start: int | Column | Callable[[int], int] = 1,
) -> DataFrame:
    """IDENTITY-style key in ``order_cols`` order, starting at ``start``."""
    return with_row_index(df, order_cols, name, start)


def next_key_after(existing: DataFrame, key_col: str) -> Column:
    """Scalar subquery ``coalesce(max(key), 0) + 1`` over an existing table."""
    return existing.select((F.coalesce(F.max(key_col), F.lit(0)) + 1).cast("long")).scalar()
