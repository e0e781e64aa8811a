"""Key ranges of equal size for parallel reads of a relational table.

A partitioned read that cuts the distance between the least and the greatest key
into equal steps gives most rows to a few connections when keys are sparse or
skewed. Here the steps follow the quantiles of the keys, so each range has about
as many rows; their number follows the table's size.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1_000_000


def quote(name: str) -> str:
    """A column name as SQL of the source: double quotes, as the standard has it."""
    return '"' + name.replace('"', '""') + '"'


def cut_points(keys: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """First keys of all ranges but the first, ascending, from the quantiles of ``keys`` (integers).

    A key that many rows share isn't cut: it makes one larger range. No rows, or
    few, give no cut. The list has one number for each range.
    """
    n = keys.count()
    ranges = ceil(n / rows_per_range)
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = keys.select(F.percentile_approx(F.col(f"`{key}`"), shares, 20 * ranges).alias("cuts")).first()["cuts"] or []
    least = keys.agg(F.min(F.col(f"`{key}`"))).first()[0]
    return sorted({int(c) for c in found if c > least})


def predicates(column: str, cuts: list[int], nullable: bool = False) -> list[str]:
    """Conditions of which every row meets exactly one. ``nullable``: null keys are in the first."""
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]}" + (f" OR {column} IS NULL" if nullable else "")
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *between, f"{column} >= {cuts[-1]}"]


def even_steps(low: int, high: int, rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Connections for reading the keys alone between two known ends."""
    return max(1, min(ceil(rows / rows_per_range), high - low + 1))
