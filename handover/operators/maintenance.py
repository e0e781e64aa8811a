"""Maintenance rewrites of target tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from handover.functions.scalars import shift_years


def shift_dates(df: DataFrame, cols: list[str], years: int) -> DataFrame:
    """``UPDATE t SET c = DATEADD(year, n, c)`` for each of ``cols``, as a new
    version of the table (a narrow projection: no shuffle)."""
    return df.withColumns({c: shift_years(c, years) for c in cols})
