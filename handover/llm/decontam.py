"""Benchmark decontamination by SimHash of item-sized windows (DataFrame functions only).

Words are runs of letters and digits of the lower-cased text; shingles are five
consecutive words (the whole item if it has fewer), weighted by how often they
occur. An item-sized window of a document matches an item if their weighted
Jaccard similarity reaches ``similarity``.

1. Only windows whose first shingle is one of the item's are made: moving a
   window right past a shingle that the item lacks never lowers its similarity,
   so the best window starts with one (at a text's end it is cut short). And only
   for documents whose shingles can reach the similarity with the item at all.
2. Windows and items get 64-bit SimHash fingerprints of (shingle, occurrence), so
   that a repeated shingle counts as often in a bit's vote as in the similarity. A
   window further than the radius from its item is dropped. The radius follows from
   the exact law of the distance: a pair that reaches the similarity is lost with a
   probability of ``LOSS`` at most, whatever the item's size.
3. What is left is verified by the exact similarity of the shingles as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.llm import scratch

WIDTH = 5
LOSS = 1e-9
_SIZES = 40  # of items in shingles; larger ones have the last radius
_BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def _hashes(words: str, width: Column) -> Column:
    """Hash of the shingle at each position of an array of word hashes."""
    return F.transform(
        F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - width + 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.slice(F.col(words), i, width)),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _numbered(values: Column, mark: Callable[[Column, Column], Column]) -> Column:
    """``mark(value, number)`` of each value, where its occurrences are numbered from 0; in any order."""
    def repeated(v: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), F.size(v)), lambda i: ~F.get(v, i - 1).eqNullSafe(F.get(v, i - 2)))
        run = lambda at, j, starts: F.coalesce(F.get(starts, j + 1), F.size(v) + 1) - at
        return _let(first, lambda starts: F.flatten(F.transform(starts, lambda at, j: F.transform(F.sequence(F.lit(0), run(at, j, starts) - 1), lambda o: mark(F.get(v, at - 1), o)))))

    return _let(values, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.transform(v, lambda x: mark(x, F.lit(0)))).otherwise(_let(F.sort_array(v), repeated)))


def _fingerprint(hashes: Column) -> Column:
    """A bit is 1 if it is set in over half of the hashes, each made different by its occurrence."""
    def bit(h: Column, b: Column) -> Column:
        ones = F.aggregate(h, F.lit(0), lambda s, x: s + F.getbit(x, b).cast("int"))
        return F.when(2 * ones > F.size(h), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))

    # shiftleft takes the distance from a column only in SQL
    return _let(_numbered(hashes, F.xxhash64), lambda h: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(F.call_function("shiftleft", bit(h, b), b))))


def _differ(both: int, a: int, b: int) -> float:
    """Probability that a fingerprint bit differs between sets of random hashes with ``both`` in common and ``a`` and ``b`` of their own."""
    law = lambda n: [comb(n, i) / 2**n for i in range(n + 1)]
    p = 0.0
    for i, w in enumerate(law(both)):
        x = sum(q for j, q in enumerate(law(a)) if 2 * (i + j) > both + a)
        y = sum(q for j, q in enumerate(law(b)) if 2 * (i + j) > both + b)
        p += w * (x * (1 - y) + y * (1 - x))
    return p


@lru_cache
def radii(similarity: float, loss: float = LOSS) -> list[int]:
    """By the item's number of shingles, from 1: the least radius that loses a similar window with probability ``loss`` at most."""
    out = []
    for total in range(1, _SIZES + 1):
        p = 0.0
        for size in range(1, total + 1):  # a window has no more shingles than the item
            least = next((s for s in range(size + 1) if s >= similarity * (total + size - s) - 1e-9), None)
            if least is not None:  # one more may do worse: an even number of hashes can tie
                p = max(p, *(_differ(s, total - s, size - s) for s in range(least, min(least + 2, size + 1))))
        tail = lambda r: sum(comb(64, i) * p**i * (1 - p) ** (64 - i) for i in range(r + 1, 65))  # noqa: B023, E731
        out.append(next(r for r in range(65) if tail(r) <= loss))
    out[-1] = max(out[_SIZES // 2 :])  # the law settles, ties matter less and less
    return out


def _bounded(df: DataFrame) -> DataFrame:
    """The frame with a broadcast hint if it is small enough, else as it is (a shuffle join)."""
    return F.broadcast(df) if scratch.is_small(df, _BROADCAST_ROWS) else df


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", item_text: str = "text", similarity: float = 0.8, radius: int | None = None) -> DataFrame:
    """(key, item, similarity, start): the best window of each document and item that reaches ``similarity``.

    ``start`` counts words from 0; the first of equally good windows is given.
    Documents with equal key and text are one document; equal items are compared
    once and listed each. Null and empty texts match nothing; nor do items
    without words. Null keys are reported like others, with a null key. Extra
    columns are not read. Without ``radius`` it is the one of ``radii``.
    """
    # distinct items, each with its shingles by position
    named = benchmark.select(F.col(f"`{item}`").alias("item"), _words(F.col(f"`{item_text}`")).alias("words")).where(F.size("words") > 0)
    named = scratch.write(named.withColumn("class", F.sha2(F.concat_ws(" ", "words"), 256)), "items")
    items = named.groupBy("class").agg(F.first("words").alias("words")).withColumn("n", F.size("words")).withColumn("k", F.least("n", F.lit(WIDTH)))
    items = items.withColumn("wh", F.transform("words", lambda w: F.xxhash64(w))).withColumn("h", _hashes("wh", F.col("k")))
    items = scratch.write(items.select("class", "words", "n", "k", "h"), "item-shingles")
    widths = sorted(r["k"] for r in items.select("k").distinct().collect())  # 1 to WIDTH
    shingles = scratch.write(items.select("class", "n", "k", F.size("h").alias("total"), F.explode("h").alias("h")).groupBy("class", "n", "k", "total", "h").agg(F.count("*").alias("w")), "item-weights")
    known = _bounded(shingles.select("k", "h").distinct())

    # places in documents whose shingle is in an item
    prepared = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text is not null").withColumn("th", F.xxhash64("text"))

    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("words", _words(F.col("text"))).withColumn("wh", F.transform("words", lambda w: F.xxhash64(w)))

    found = None
    for k in widths:
        at = hashed(prepared).select("key", "th", F.posexplode(_hashes("wh", F.lit(k))).alias("at", "h")).withColumn("k", F.lit(k))
        at = at.join(known, ["k", "h"])
        found = at if found is None else found.unionByName(at)
    if found is None:
        return docs.limit(0).select(F.col(f"`{key}`").alias(key), F.lit(None).cast(benchmark.schema[item].dataType).alias(item), F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("start"))
    places = scratch.write(found.distinct(), "places")  # equal rows are one document

    # documents that can reach the similarity with an item
    doc = ["key", "th"]
    shared = places.groupBy(*doc, "k", "h").agg(F.count("*").alias("c")).join(_bounded(shingles), ["k", "h"])
    pairs = shared.groupBy(*doc, "class", "n", "k", "total").agg(F.sum(F.least("c", "w")).alias("s")).where(F.col("s") >= similarity * F.col("total") - 1e-9).drop("s", "total")
    pairs = scratch.write(pairs, "pairs")
    starts = places.join(shingles.select("class", "k", "h"), ["k", "h"]).select(*doc, "class", "at").alias("s")
    starts = starts.join(pairs.alias("p"), F.expr("s.key <=> p.key and s.th = p.th and s.class = p.class")).select("p.*", "s.at")

    # windows within the radius of their item, and what they share with it
    wanted = pairs.select(*doc).distinct()
    words = prepared.alias("d").join(_bounded(wanted).alias("w"), F.expr("d.key <=> w.key and d.th = w.th"), "left_semi")
    words = hashed(words).select("key", "th", "words", "wh")
    texts = scratch.write(words.groupBy(*doc).agg(F.first("words").alias("words"), F.first("wh").alias("wh")), "leak-texts")
    windows = starts.alias("s").join(texts.alias("t"), F.expr("s.key <=> t.key and s.th = t.th")).select("s.*", F.slice("t.words", F.col("at") + 1, F.col("n")).alias("words"), F.slice("t.wh", F.col("at") + 1, F.col("n")).alias("wh"))
    windows = windows.withColumn("fp", _fingerprint(_hashes("wh", F.col("k")))).drop("wh")
    target = scratch.write(items.select("class", F.col("words").alias("item_words"), F.size("h").alias("total"), _fingerprint(F.col("h")).alias("item_fp")), "item-fingerprints")
    within = F.lit(radius) if radius is not None else F.element_at(F.array(*map(F.lit, radii(similarity))), F.least("total", F.lit(_SIZES)))
    near = windows.join(_bounded(target), "class").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= within)
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - F.col("k") + 1), lambda i: F.concat_ws(" ", F.slice(F.col(c), i, F.col("k"))))
    unlike = lambda c: _numbered(grams(c), lambda g, o: F.concat_ws(" ", g, o.cast("string")))
    # numbered by occurrence, the weighted intersection is a plain one
    shares = near.select(*doc, "class", "at", "total", (F.size("words") - F.col("k") + 1).alias("size"), F.size(F.array_intersect(unlike("words"), unlike("item_words"))).alias("s"))
    shares = scratch.write(shares, "shares")
    scored = shares.withColumn("similarity", F.col("s") / (F.col("total") + F.col("size") - F.col("s")))
    best = scored.where(F.col("similarity") >= similarity - 1e-12).groupBy("key", "class").agg(F.max(F.struct("similarity", (-F.col("at")).alias("back"))).alias("b"))
    return best.join(named.select("class", "item"), "class").select(F.col("key").alias(key), F.col("item").alias(item), F.col("b.similarity").alias("similarity"), (-F.col("b.back")).cast("long").alias("start"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that hold a benchmark item (documents with a null key are compared by text)."""
    plain = docs.select(*(F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns))
    tag = F.coalesce(F.col(f"`in_{key}`").cast("string"), F.concat(F.lit("text "), F.sha2(F.col(f"`in_{text}`"), 256)))
    keyed = plain.withColumn("tag", tag)
    leaks = find_leaks(keyed, benchmark, f"in_{text}", "tag", **options).select("tag").distinct()
    leaks = scratch.write(leaks, "leaks")
    return keyed.join(_bounded(leaks), "tag", "left_anti").select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))
