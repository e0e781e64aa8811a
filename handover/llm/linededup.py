"""Removal of repeated passages by overlapping three-line windows.

A line counts if it holds a word; lines are compared without the white space
around them. Every three consecutive lines that count form a window (lines
without a word between them are skipped over). Windows are compared by a
128-bit hash. Of equal windows in the whole table the first occurrence stays,
by document key, then row, then place; in all later ones every covered line is
removed. Overlapping covered lines merge, so a passage of any length of at least
three lines goes as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handover.llm import scratch

_SIZE = 3


def remove_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with later occurrences of repeated three-line windows cut from ``text``, plus ``n_lines`` and ``n_removed``.

    Every row stays, in the same columns; ``n_lines`` and ``n_removed`` are
    replaced if there. A text without removed lines is returned unchanged, a null
    text as null (0 lines). A text of which every line goes becomes empty. A text
    with fewer than three lines that count has no window and stays. Repeated
    rows are documents like others: the first one stays. Null keys come last.
    """
    made = ("n_lines", "n_removed")
    keep = [c for c in docs.columns if c not in made]
    # a written copy: its row numbers don't change if a task runs again
    rows = scratch.write(docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in keep), F.monotonically_increasing_id().alias("__row")), "line-docs")
    text, key = f"in_{text}", f"in_{key}"  # no clash with the helpers' names
    lines = F.transform(F.split(F.col(f"`{text}`"), "\n", -1), lambda x, i: F.struct(i.alias("at"), F.regexp_replace(x, "^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$", "").alias("line")))
    listed = rows.where(F.col(f"`{text}`").contains("\n")).select(F.col(f"`{key}`").alias("__key"), "__row", F.filter(lines, lambda x: x["line"] != "").alias("__l"))
    triple = F.arrays_zip(*(F.slice("__l", i + 1, F.greatest(F.size("__l") - _SIZE + 1, F.lit(0))).alias(f"l{i}") for i in range(_SIZE)))
    windows = listed.where(F.size("__l") >= _SIZE).select(
        "__key", "__row", F.explode(F.transform(triple, lambda w: F.struct(
            F.xxhash64(*(w[f"l{i}"]["line"] for i in range(_SIZE))).alias("h1"),
            F.xxhash64(F.lit("second"), *(w[f"l{i}"]["line"] for i in range(_SIZE))).alias("h2"),
            *(w[f"l{i}"]["at"].alias(f"a{i}") for i in range(_SIZE)),
        ))).alias("w"),
    ).select("__key", "__row", "w.*")
    windows = scratch.write(windows, "line-windows")
    place = F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("key"), F.col("__row").alias("row"), F.col("a0").alias("at"))
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = windows.join(repeated, ["h1", "h2"]).where((F.col("__row") != F.col("first.row")) | (F.col("a0") != F.col("first.at")))
    covered = later.groupBy("__row").agg(F.array_distinct(F.flatten(F.collect_list(F.array(*(f"a{i}" for i in range(_SIZE)))))).alias("__gone"))
    covered = scratch.write(covered, "line-covered")
    # the texts move once at every size; a hash join on the small side leaves them unsorted
    cut = rows.join(covered.hint("shuffle_hash"), "__row", "left").withColumn("__all", F.split(F.col(f"`{text}`"), "\n", -1))
    n = F.coalesce(F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size("__all")), F.lit(0))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__all") - 1), F.col("__gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(F.col("__all"), i)), "\n")
    return cut.select(
        *((F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(left) if f"in_{c}" == text else F.col(f"`in_{c}`")).alias(c) for c in keep),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
