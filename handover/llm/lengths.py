"""Exact token counts from the histogram of encoded lengths.

Documents are counted by their number of tokens; sums from the longest length
down then answer every context limit: how many documents and tokens lie at or
above it, and how many tokens remain if texts are cut there. The sums run in
two steps, over ranges of lengths and inside each range, so no task gets more
than a range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from handover.llm import scratch
from handover.llm.batches import chunks
from handover.llm.bpe import codec

_RANGE = 1024


def histogram(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(length, n_docs): documents by encoded length; null and empty texts have length 0. Repeated rows count each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in chunks(batches, text):
            length, n = np.unique(np.diff(c.encode(part.column(text))[1]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], names=["length", "n_docs"])

    return docs.select(F.col(f"`{text}`")).mapInArrow(run, "length long, n_docs long").groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row per length L: documents and tokens of length >= L, documents <= L, and the tokens left if texts are cut at L.

    An empty histogram gives no rows.
    """
    hist = scratch.write(hist, "lengths").withColumn("range", F.expr(f"length div {_RANGE}"))
    down = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    per_range = hist.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t"))
    every = Window.partitionBy()
    above = per_range.select("range", F.coalesce(F.sum("d").over(down), F.lit(0)).alias("d_above"), F.coalesce(F.sum("t").over(down), F.lit(0)).alias("t_above"), F.sum("d").over(every).alias("docs"), F.sum("t").over(every).alias("tokens"))
    inside = Window.partitionBy("range").orderBy(F.desc("length"))
    d = F.sum("n_docs").over(inside) + F.col("d_above")
    t = F.sum(F.col("n_docs") * F.col("length")).over(inside) + F.col("t_above")
    rows = hist.join(above, "range").select("length", "n_docs", d.alias("docs_at_least"), t.alias("tokens_at_least"), "docs", "tokens")
    return rows.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
    )


def truncated_totals(sums: DataFrame, limits: list[int]) -> dict[int, tuple[int, int]]:
    """For each limit: tokens left if texts are cut there, and the number of texts cut; (0, 0) on an empty table."""
    total = sums.agg(F.max(F.struct("docs_at_least", "tokens_at_least"))).first()[0]
    picks = [F.min_by(F.struct("docs_at_least", "tokens_at_least"), F.when(F.col("length") > limit, F.col("length"))).alias(str(limit)) for limit in limits]
    found = sums.agg(*picks).first()
    out = {}
    for limit in limits:
        over = found[str(limit)]
        docs, tokens = (over["docs_at_least"], over["tokens_at_least"]) if over else (0, 0)
        out[limit] = ((total["tokens_at_least"] if total else 0) - tokens + limit * docs, docs)
    return out


def quantiles(sums: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """Smallest length that at least the given share of documents doesn't exceed; None on an empty table."""
    n = sums.agg(F.max("docs_at_least")).first()[0]
    if not n:
        return {q: None for q in shares}
    found = sums.agg(*(F.min(F.when(F.col("docs_at_most") >= math.ceil(q * n), F.col("length"))).alias(str(i)) for i, q in enumerate(shares))).first()
    return {q: found[str(i)] for i, q in enumerate(shares)}
