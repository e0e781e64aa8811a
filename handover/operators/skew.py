"""Joins whose key may hold a large part of the rows, split without help of the optimiser.

The heavy keys are found by a frequent-items sketch in one pass (partial
sketches in the tasks, one small state to the driver). Rows of a heavy key are
dealt to several parts by a hash of the columns that identify them, and the
other side's rows of that key are repeated once for each part. All other keys
have one part. Every left row meets each right row of its key once, so inner,
left outer, semi and anti joins keep their meaning.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it holds more than this share of the rows; each of its parts has about as much.
SHARE = 1 / 512
_TRACKED = 16_384  # counters of the sketch: its error is far below SHARE


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> dict[int, int]:
    """Hash of each key with more than ``share`` of the rows, and the parts it is dealt to.

    At most ``1 / share`` keys, whatever the number of rows. Null is a key like
    others. Counted by hash: two keys of one hash count as one, which splits
    both and harms nothing. An empty frame has none.
    """
    top = f"approx_top_k(k, {ceil(1 / share)}, {_TRACKED})"
    found = df.select(F.xxhash64(F.col(f"`{key}`")).alias("k")).agg(F.count("*").alias("n"), F.expr(top).alias("top")).first()
    most = found["n"] * share
    return {r["item"]: ceil(r["count"] / max(most, 1)) for r in found["top"] or [] if r["count"] > most}


def _parts(heavy: dict[int, int], key: Column) -> Column:
    if not heavy:
        return F.lit(1)
    known = F.create_map(*(F.lit(x) for pair in heavy.items() for x in pair))
    return F.coalesce(F.element_at(known, F.xxhash64(key)), F.lit(1))


def split_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str,
    spread: list[str],
    *,
    heavy: dict[int, int] | None = None,
    share: float = SHARE,
    null_safe: bool = False,
    condition=None,
) -> DataFrame:
    """``left`` join ``right`` on one key each, heavy keys of ``left`` split.

    ``how``: inner, left, left_semi or left_anti. ``spread``: columns that tell
    the rows of a heavy key apart; the part is a function of them, so a task that
    runs again deals its rows alike. ``right`` should have few rows for a heavy
    key, as they are repeated. ``condition(left, right)`` adds a further test
    over the two frames' columns. Column names must not clash between the sides.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how: {how!r}")
    heavy = heavy_keys(left, left_key, share) if heavy is None else heavy
    lk, rk = F.col(f"`{left_key}`"), F.col(f"`{right_key}`")
    part = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in spread)), _parts(heavy, lk)).cast("int")
    a = left.withColumn("__part", part)
    b = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), _parts(heavy, rk) - 1)) if heavy else F.lit(0))
    same = a[f"`{left_key}`"].eqNullSafe(b[f"`{right_key}`"]) if null_safe else a[f"`{left_key}`"] == b[f"`{right_key}`"]
    on = same & (a["__part"] == b["__copy"])
    if condition is not None:
        on = on & condition(a, b)
    return a.join(b, on, how).drop("__part", "__copy")
