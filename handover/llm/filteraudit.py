"""Audit of a set of document filters: what each removes in every order of application.

Each document gets one bit for each filter that it fails. Most filters look at
the text alone. The duplicate filter is an existential self-join: a document
fails it if a document of the same text has a smaller key, found by a left-semi
join on the text's hash, the exact text and the smaller key. The marked ids are
united with the failures of the other filters, and the bits of an id are put
together by an aggregate. What follows needs only the counts of the bit
combinations, of which there are 2 ** filters at most in each part.

A text that holds a large part of the table is no hot key: the right side of the
semi-join has one row for each distinct repeated text, made with map-side
combining, and the left side's rows of a heavy hash are split over several tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from handover.llm import scratch
from handover.operators.skew import heavy_keys, split_join

DUPLICATE = "E"
_SPACES = "[ \\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACES, -1), lambda w: w != "")


#: Letter and failure condition of the filters on a (non-null) text and its words.
TEXT_FILTERS: dict[str, Callable[[Column, Column], Column]] = {
    "A": lambda text, words: F.size(words) < 200,
    "B": lambda text, words: F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50,
    "C": lambda text, words: F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 3,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}


def failures(
    docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang", filters: dict[str, Callable[[Column, Column], Column]] | None = None, duplicate: str | None = DUPLICATE
) -> DataFrame:
    """(key, part, bits, n): rows of ``docs`` by key, part and failed filters; bit i is the i-th filter's, the duplicate filter's the last.

    Null texts are empty, a null part is the empty string. Rows with a null key
    never fail the duplicate filter and make no other row fail it; nor do rows of
    one key. Very long texts are read whole. An empty table gives no rows. Other
    columns are not read, so their names can't clash. ``duplicate=None`` leaves
    the duplicate filter out.
    """
    filters = TEXT_FILTERS if filters is None else filters
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), body.alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit("second"), "text"))
    bits = F.lit(0)
    for i, fails in enumerate(filters.values()):
        bits = bits.bitwiseOR(F.when(fails(F.col("text"), F.col("words")), 1 << i).otherwise(0))
    ids = ["key", "part", "h", "h2"]
    measured = hashed.withColumn("words", _words(F.col("text"))).select(*ids, bits.alias("bits"))
    if duplicate is None:
        return measured.groupBy("key", "part", "bits").agg(F.count("*").alias("n"))
    measured = scratch.write(measured, "filter-bits")
    marked = _later_copies(hashed, measured, ids).select(*ids, F.lit(1 << len(filters)).alias("bits"), F.lit(0).alias("n"))
    united = measured.select(*ids, "bits", F.lit(1).alias("n")).unionByName(marked)
    whole = united.groupBy(*ids).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    return whole.groupBy("key", "part", "bits").agg(F.sum("n").alias("n"))


def _later_copies(hashed: DataFrame, measured: DataFrame, ids: list[str]) -> DataFrame:
    """Rows whose text also occurs with a smaller key."""
    repeated = measured.groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high")
    repeated = scratch.write(repeated.select(F.col("h").alias("hash")), "filter-hashes")
    heavy = heavy_keys(measured, "h")
    # the place of a row also tells repeated rows of one key apart
    spread = ["key", "place"]
    rows = hashed.withColumn("place", F.spark_partition_id())
    rows = scratch.write(split_join(rows, repeated, "h", "hash", "left_semi", spread, heavy=heavy), "filter-copies")
    first = rows.groupBy(F.col("h").alias("hash"), F.col("text").alias("copy")).agg(F.min("key").alias("first"))
    return split_join(rows, first, "h", "hash", "left_semi", spread, heavy=heavy, condition=lambda a, b: (a["text"] == b["copy"]) & (b["first"] < a["key"]))


def label_flags(labels: DataFrame, key: str = "doc_id", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(key, good, toxic): 1 if any label row of the key says 1. Null keys and labels say nothing."""
    one = lambda c: F.max(F.coalesce((F.col(f"`{c}`") == 1).cast("int"), F.lit(0)))
    return labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(one(good).alias("good"), one(toxic).alias("toxic"))


def interactions(failed: DataFrame, flags: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from ``failures`` and ``label_flags``.

    Every part has a row for each step of each order of ``letters`` (the filters
    in bit order), zeros included. What a filter removes depends on the set of
    filters before it, not on their order, so each (set, filter) is counted once
    and then listed for its orders.
    """
    k = len(letters)
    n = F.col("n")
    combos = (
        failed.join(flags, "key", "left")
        .groupBy("part", "bits")
        .agg(F.sum("n").alias("n"), F.sum(n * F.coalesce("good", F.lit(0))).alias("good"), F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )
    cases = [(before, f, factorial(before.bit_count()) * factorial(k - 1 - before.bit_count())) for f in range(k) for before in range(1 << k) if not before >> f & 1]
    case = F.array(*(F.struct(F.lit(b).alias("before"), F.lit(1 << f).alias("own"), F.lit(w).alias("weight")) for b, f, w in cases))
    held = lambda x: F.col("bits").bitwiseAND(x)
    here = (held(F.col("own")) != 0) & (held(F.col("before")) == 0)
    total = lambda test, what="n": F.sum(F.when(test, F.col(what)).otherwise(0)).cast("long")
    counted = (
        combos.withColumn("case", F.explode(case))
        .select("*", "case.*")
        .groupBy("part", "before", "own", "weight")
        .agg(
            total(held(F.col("before").bitwiseOR(F.col("own"))) == 0).alias("kept"),
            total(here).alias("removed"),
            total((held(F.col("own")) != 0) & (held(F.col("before")) != 0)).alias("redundant"),
            total(F.col("bits") == F.col("own")).alias("unique_fails"),
            total(here, "good").alias("good_lost"),
            total(here, "toxic").alias("toxic_lost"),
        )
        # 2 ** (filters - 1) rows for each part and filter
        .withColumn("shapley", F.sum(F.col("weight") * F.col("removed")).over(Window.partitionBy("part", "own")).cast("long"))
    )
    steps: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in permutations(range(k)):
        for i, f in enumerate(order):
            steps.setdefault((sum(1 << g for g in order[:i]), 1 << f), []).append(("".join(letters[g] for g in order), i + 1))
    rows = [(b, o, name, step) for (b, o), found in steps.items() for name, step in found]
    listed = failed.sparkSession.createDataFrame(rows, "before int, own int, filter_order string, step int")
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    # filters! x filters rows, whatever the data
    return counted.join(F.broadcast(listed), ["before", "own"]).select("part", "filter_order", "step", *counts)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """``interactions`` of the four text filters and the duplicate filter over whole ``docs``."""
    return interactions(failures(docs, text, key, part), label_flags(labels, key), "".join(TEXT_FILTERS) + DUPLICATE)
