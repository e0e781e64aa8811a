"""Exact distinct counts as sets of bits, which add up across groups and runs.

An integer id is bit ``id % 64`` of the word ``id div 64``. A set is a row for
each word that has a bit, made with ``bit_or``: an ordinary hash aggregate with
map-side combining, in place of the copy of every row for each DISTINCT that
several distinct counts in one aggregate cost. Ids given out in sequence share
words, so a set has up to 64 times fewer rows than members; other ids work too.

Sets of parts of the data are merged by ``bit_or`` again, so they can be kept as
a table that each run adds to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SET, WORD, BITS, ROWS = "set", "word", "bits", "rows"


def bit_sets(df: DataFrame, group: list[str], *members: str) -> DataFrame:
    """(group, set, word, bits, rows): the distinct ids in each of the ``members`` columns (integers) by group.

    All sets are made in one pass; ``set`` is the column's name and ``rows`` the
    number of rows with an id of the word. Null ids are no members.
    """
    entry = lambda c: F.struct(F.lit(c).alias(SET), F.col(f"`{c}`").cast("long").alias("id"))
    ids = df.select(*group, F.explode(F.array(*(entry(c) for c in members))).alias("m")).select(*group, "m.*").where("id is not null")
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    return ids.groupBy(*group, SET, F.shiftright("id", 6).alias(WORD)).agg(F.bit_or(bit).alias(BITS), F.count(F.lit(1)).alias(ROWS))


def merged(sets: list[DataFrame], group: list[str]) -> DataFrame:
    """The union of sets, by ``group`` (all or some of their group columns)."""
    rows = reduce(DataFrame.unionByName, [s.select(*group, SET, WORD, BITS, ROWS) for s in sets])
    return rows.groupBy(*group, SET, WORD).agg(F.bit_or(BITS).alias(BITS), F.sum(ROWS).alias(ROWS))


def sizes(sets: DataFrame, group: list[str], rows: dict[str, str] | None = None, **names: str) -> DataFrame:
    """One row for each group: ``names`` maps a column to the set whose members it counts, ``rows`` to the set whose rows."""
    count = lambda what, of: F.coalesce(F.sum(F.when(F.col(SET) == of, what)), F.lit(0)).cast("long")
    cols = [count(F.bit_count(BITS), of).alias(n) for n, of in names.items()] + [count(F.col(ROWS), of).alias(n) for n, of in (rows or {}).items()]
    return sets.groupBy(*group).agg(*cols)
