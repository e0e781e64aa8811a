"""Quality rules with risk-controlled thresholds.

Every document gets exact text measures. For each stratum and each measure a
cutoff is chosen on labelled documents: the strictest one of a fixed grid for
which the exact binomial (Clopper-Pearson) upper bound of the share of good
documents rejected stays within the rule's part of ``max_false_rejection``. The
cutoffs of a grid are tested in fixed order, from the loosest to the first that
fails, so together they take the error of one test. It is divided by strata x
rules: with probability ``1 - error`` the guarantee holds in all strata at once.
A stratum with too few labels for any guarantee gets no cutoff.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handover.llm import scratch
from handover.llm.batches import chunks, codes, ragged, text_bytes, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks")
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: name, measure as SQL over MEASURES, and the grid of cutoffs; a document with a measure at or above its cutoff is rejected.
_SHARES = tuple(round(0.02 * i, 2) for i in range(1, 26))
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", _SHARES),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", _SHARES),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", _SHARES),
    "upper_case": ("n_upper / greatest(word_chars, 1)", _SHARES),
    "marks": ("n_marks / greatest(n_words, 1)", _SHARES),
    "long_words": ("word_chars / greatest(n_words, 1)", tuple(float(x) for x in range(6, 31))),
    "short_words": ("-word_chars / greatest(n_words, 1)", tuple(-round(0.2 * x, 1) for x in range(25, 0, -1))),
}


def _same_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal pairs get equal codes."""
    key = pa.array(a * (int(b.max()) + 1 if len(b) else 1) + b)
    return key.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def measures(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The MEASURES of each row of a text buffer."""
    rows = len(off) - 1
    start, length, row = words(data, off)
    n_words = np.bincount(row, minlength=rows)

    def per_row(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[off])

    blank = np.zeros(256, bool)
    blank[[0x20, *range(9, 14)]] = True
    symbol = np.zeros(256, bool)
    symbol[[ord(c) for c in "#*$%&|<>"]] = True
    word_chars = per_row(~blank[data] & ((data & 0xC0) != 0x80))
    n_symbols = per_row(symbol[data])
    n_upper, n_marks = per_row((data >= 65) & (data <= 90)), per_row(data == ord("!"))
    # lines with a word, equal to an earlier one of the row
    feed = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([off[:-1], feed + 1]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    end = end - (data[end - 1] == 0x0A) if len(end) else end
    has = np.searchsorted(start, begin) < np.searchsorted(start, end)
    begin, end = begin[has], end[has]
    line_row = np.searchsorted(off, begin, "right") - 1
    n_lines = np.bincount(line_row, minlength=rows)
    n_dup = np.zeros(rows, np.int64)
    if len(begin):
        code, _ = codes(data, begin, end - begin)
        distinct = np.unique(_same_pairs(line_row, code), return_index=True)[1]
        n_dup = n_lines - np.bincount(line_row[distinct], minlength=rows)
    # words in windows that the row has twice: codes of 1, 2, 4 and 8 words
    n_repeat = np.zeros(rows, np.int64)
    if len(start):
        code, _ = codes(data, start, length)
        at, step = np.arange(len(start)), 1
        while step < WINDOW:
            ok = at + 2 * step - 1 < len(start)
            ok[ok] = row[at[ok]] == row[at[ok] + 2 * step - 1]
            place = np.full(len(start), -1, np.int64)
            place[at] = np.arange(len(at))
            at = at[ok]
            code = _same_pairs(code[place[at]], code[place[at + step]]) if len(at) else code[:0]
            step *= 2
        if len(at):
            both = _same_pairs(row[at], code)
            twice = at[np.bincount(both)[both] > 1]
            cover = np.zeros(len(start) + 1, np.int64)
            np.add.at(cover, twice, 1)
            np.add.at(cover, twice + WINDOW, -1)
            n_repeat = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=rows)
    return [n_words, word_chars, n_symbols, n_dup, n_repeat, n_lines, n_upper, n_marks]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the MEASURES (long) of every whole text; null counts as empty (all zero).

    Columns named like a measure are replaced; other columns and repeated rows
    stay. Narrow: no shuffle.
    """
    keep = [c for c in docs.columns if c not in MEASURES]
    src = docs.select(*(F.col(f"`{c}`") for c in keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text):
            found = measures(*text_bytes(part.column(text)))
            yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, pa.int64()) for x in found)], names=[*part.schema.names, *MEASURES])

    return src.mapInArrow(run, T.StructType([*src.schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)]))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p)."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def base_failed():
    return F.expr(f"n_words < {MIN_WORDS} or {100} * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def choose_cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", label: str = "quality", max_false_rejection: float = 0.05, error: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff, n_good, false_rejected, caught): the chosen cutoffs; a stratum or rule without one has no row.

    Labels are 1 for good; a document with both labels counts as not good; null
    keys and null labels are ignored. Documents that fail the base rules are
    left out: the guarantee is for those that reach the rules. Null is a stratum
    like any other. The counts are one row per (stratum, rule, cutoff).
    """
    known = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("__key")).agg(F.min(F.col(f"`{label}`")).alias("__good"))
    rows = measured.where(~base_failed()).select(F.col(f"`{key}`").alias("__key"), F.col(f"`{stratum}`").cast("string").alias("stratum"), *MEASURES).join(known, "__key")
    # a value passes the first so many cutoffs of its grid, so one small histogram per stratum and rule holds all counts
    rule = F.array(*(F.struct(F.lit(name).alias("rule"), F.expr(f"size(filter(array({', '.join(f'{c}D' for c in grid)}), c -> cast({sql} as double) >= c))").alias("level")) for name, (sql, grid) in RULES.items()))
    levels = rows.select("stratum", "__good", F.explode(rule).alias("r")).groupBy("stratum", "r.rule", "r.level").agg(F.sum(F.expr("int(__good = 1)")).alias("good"), F.sum(F.expr("int(__good <> 1)")).alias("bad"))
    levels = scratch.write(levels, "levels")
    strata = max(1, levels.select("stratum").distinct().count())
    tests = strata * len(RULES)
    limit = max_false_rejection / len(RULES)

    def choose(key_: tuple, found: pd.DataFrame) -> pd.DataFrame:
        name = found["rule"].iloc[0]
        grid = RULES[name][1]
        n = int(found["good"].sum())
        best = None
        for i in range(len(grid) - 1, -1, -1):  # from the loosest cutoff on
            over = found[found["level"] > i]
            k, caught = int(over["good"].sum()), int(over["bad"].sum())
            if not n or binomial_at_most(k, n, limit) > error / tests:
                break
            if caught:
                best = (found["stratum"].iloc[0], name, grid[i], n, k, caught)
        return pd.DataFrame([best] if best else [], columns=["stratum", "rule", "cutoff", "n_good", "false_rejected", "caught"])

    return levels.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff double, n_good long, false_rejected long, caught long")


def judge(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to measured documents."""
    wide = cutoffs.groupBy(F.col("stratum").alias("__stratum")).agg(*(F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"__{name}") for name in RULES))
    wide = scratch.write(wide, "cutoffs")
    if scratch.is_small(wide, 10_000):
        wide = F.broadcast(wide)
    df = measured.drop("base_failed", "kept")
    df = df.withColumn("base_failed", base_failed()).join(wide, F.col(f"`{stratum}`").cast("string").eqNullSafe(F.col("__stratum")), "left")
    caught = " or ".join(f"coalesce(cast({sql} as double) >= __{name}, false)" for name, (sql, _) in RULES.items())
    return df.withColumn("kept", ~F.col("base_failed") & ~F.expr(caught)).drop("__stratum", *(f"__{name}" for name in RULES))


def filter_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass the base rules and their stratum's cutoffs, with the columns of ``docs``."""
    own = {c: f"in_{c}" for c in docs.columns}  # no clash with the measures and helpers
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()))
    cutoffs = choose_cutoffs(measure(plain.select(own[key], own[stratum], own[text]), own[text]).drop(own[text]), labels.withColumnRenamed(key, own[key]), own[stratum], own[key])
    judged = judge(measure(plain, own[text]), scratch.write(cutoffs, "chosen"), own[stratum])
    return judged.where("kept").select(*(F.col(f"`{n}`").alias(c) for c, n in own.items()))
