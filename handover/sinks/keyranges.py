"""Ranges of generated keys, reserved so that runs at the same time share none.

A reservation is a file made once (``sinks.marker``), named by its number and
holding the first and last key. A run that wants n keys continues after the last
reservation; if another run makes that file first, it looks again. Keys of a run
that fails stay unused, as those of an IDENTITY column do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from handover.sinks.marker import names, put_once, text_of

KEYS = "_keys"


def reserve(spark: SparkSession, root: str, table: str, n: int, first: int = 1) -> int:
    """The first of ``n`` keys in a row that no other reservation holds, at least ``first``."""
    if n <= 0:
        return first
    folder = f"{root.rstrip('/')}/{KEYS}/{table}"
    while True:
        taken = names(spark, folder)
        start = max(first, int(text_of(spark, f"{folder}/{taken[-1]}").split()[1]) + 1) if taken else first
        number = int(taken[-1]) + 1 if taken else 0
        if put_once(spark, f"{folder}/{number:020d}", f"{start} {start + n - 1}"):
            return start


def reservations(spark: SparkSession, root: str, table: str) -> list[tuple[int, int]]:
    """(first, last) of all reservations, in order."""
    folder = f"{root.rstrip('/')}/{KEYS}/{table}"
    return [tuple(map(int, text_of(spark, f"{folder}/{n}").split())) for n in names(spark, folder)]
