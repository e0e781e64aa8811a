"""Change audit: insert/update/delete log rows with old and new row images.

``audit_diff`` derives the changes from two snapshots of a table (a full
outer join on the key; each key has at most one row per side, so there is
no hot group). ``audit_from_feed`` maps an explicit change feed (op,
before, after) to the same rows; the streaming job uses it per micro-batch.
One log row per changed row; images are JSON text of the whole row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from handover.functions.scalars import ntz_lit
from handover.operators.keys import with_surrogate_key
from handover.operators.sizing import measured

# Operation letters of the log.
INSERT, UPDATE, DELETE = "I", "U", "D"

LOG_COLS = ["log_id", "table_name", "operation", "key_values", "change_date", "changed_by"]
VALUES_COLS = ["log_values_id", "log_id", "old_values", "new_values"]


def _image(s: Column) -> Column:
    return F.to_json(s)


def _key_json(s: Column, keys: list[str]) -> Column:
    return F.to_json(F.struct(*[s[k].alias(k) for k in keys]))


def audit_diff(
    before: DataFrame,
    after: DataFrame,
    keys: list[str],
    table_name: str,
    change_date: dt.datetime | None = None,
    changed_by: str | None = None,
) -> DataFrame:
    """Changes between two snapshots: (table_name, operation, key_values,
    old_values, new_values, change_date, changed_by, <key columns>).

    An update is logged only when some column differs (null-safe); a
    snapshot diff cannot see updates that change nothing. Without
    ``change_date``/``changed_by`` the session's time and user are written.
    """
    cols = before.columns
    b = before.select(F.struct(*cols).alias("__b"), *[F.col(k).alias(f"__bk_{k}") for k in keys])
    a = after.select(F.struct(*after.columns).alias("__a"), *[F.col(k).alias(f"__ak_{k}") for k in keys])
    j = b.join(a, [b[f"__bk_{k}"] == a[f"__ak_{k}"] for k in keys], "full_outer")
    op = F.when(F.col("__a").isNull(), F.lit(DELETE)).when(F.col("__b").isNull(), F.lit(INSERT)).otherwise(F.lit(UPDATE))
    value_cols = [c for c in cols if c not in keys]
    changed = F.lit(False)
    for c in value_cols:
        changed = changed | ~F.col("__b")[c].eqNullSafe(F.col("__a")[c])
    j = j.withColumn("operation", op).filter((F.col("operation") != F.lit(UPDATE)) | changed)
    # The logged key is the old key for updates and deletes, the new one for inserts.
    key_src = F.when(F.col("operation") == F.lit(INSERT), F.col("__a")).otherwise(F.col("__b"))
    return j.select(
        F.lit(table_name).alias("table_name"),
        "operation",
        _key_json(key_src, keys).alias("key_values"),
        F.when(F.col("operation") != F.lit(INSERT), _image(F.col("__b"))).alias("old_values"),
        F.when(F.col("operation") != F.lit(DELETE), _image(F.col("__a"))).alias("new_values"),
        (ntz_lit(change_date) if change_date else F.localtimestamp()).alias("change_date"),
        (F.lit(changed_by) if changed_by else F.current_user()).alias("changed_by"),
        *[key_src[k].alias(k) for k in keys],
    )


#: Microseconds are part of a row's digest.
_EXACT = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
RANGES = 4_096


def _digests(df: DataFrame, keys: list[str], ranges: int) -> DataFrame:
    """(range, keys, d): SHA-256 of each row's whole image, and the hash range of its key."""
    image = F.to_json(F.struct(*df.columns), _EXACT)
    return df.select(F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("__range"), *keys, F.unhex(F.sha2(image, 256)).alias("__d"))


def _range_sums(digests: DataFrame, name: str) -> DataFrame:
    """(range, sum): 256 bits for each range, the same for the same rows in whatever order."""
    part = lambda i: F.conv(F.substring(F.hex("__d"), 16 * i + 1, 16), 16, -10).cast("long")
    sums = digests.groupBy("__range").agg(F.count(F.lit(1)).alias("n"), *(F.bit_xor(part(i)).alias(f"x{i}") for i in range(4)))
    return sums.select("__range", F.struct("n", *(f"x{i}" for i in range(4))).alias(name))


def audit_diff_by_digest(
    before: DataFrame,
    after: DataFrame,
    keys: list[str],
    table_name: str,
    change_date: dt.datetime | None = None,
    changed_by: str | None = None,
    ranges: int = RANGES,
) -> DataFrame:
    """``audit_diff`` for large snapshots that are mostly equal: the rows of both are
    shuffled only where they differ.

    Rows are compared by SHA-256 of their images: first as one sum for each of
    ``ranges`` hash ranges of the key, then, in the ranges that differ, by key;
    the images of the keys that differ are compared in full. Rows of one key with
    equal digests count as unchanged. Keys are unique and not null.
    """
    cols = before.columns
    old, new = _digests(before, keys, ranges), _digests(after.select(*cols), keys, ranges)
    both = _range_sums(old, "a").join(_range_sums(new, "b"), "__range", "full_outer")  # ``ranges`` rows at most
    differ = measured(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("__range"), "ranges-that-differ")
    within = lambda d: d.join(F.broadcast(differ), "__range", "left_semi").select(*keys, "__d")
    a, b = within(old).withColumnRenamed("__d", "__a"), within(new).withColumnRenamed("__d", "__b")
    changed = measured(a.join(b, keys, "full_outer").where(~F.col("__a").eqNullSafe(F.col("__b"))).select(*keys), "keys-that-differ")
    pick = lambda df: df.join(changed, keys, "left_semi").select(*cols)  # noqa: E731  # its size is known: broadcast if small
    return audit_diff(pick(before), pick(after), keys, table_name, change_date, changed_by)


def audit_from_feed(feed: DataFrame, keys: list[str], *also: str) -> DataFrame:
    """Log rows from a change feed with columns (table_name, op, before,
    after, change_date, changed_by); ``before``/``after`` are row structs.
    Every feed record is logged, including updates that change nothing.
    ``also``: further columns of the feed to keep."""
    key_src = F.when(F.col("op") == F.lit(INSERT), F.col("after")).otherwise(F.col("before"))
    return feed.select(
        "table_name",
        F.col("op").alias("operation"),
        _key_json(key_src, keys).alias("key_values"),
        F.when(F.col("op") != F.lit(INSERT), _image(F.col("before"))).alias("old_values"),
        F.when(F.col("op") != F.lit(DELETE), _image(F.col("after"))).alias("new_values"),
        "change_date",
        "changed_by",
        *also,
        *[key_src[k].alias(k) for k in keys],
    )


def audit_inserts(
    inserted: DataFrame, keys: list[str], table_name: str, change_date: dt.datetime | None = None, changed_by: str | None = None
) -> DataFrame:
    """Log rows of newly inserted rows, as the insert trigger of the table writes them."""
    row = F.struct(*inserted.columns)
    return inserted.select(
        F.lit(table_name).alias("table_name"),
        F.lit(INSERT).alias("operation"),
        _key_json(row, keys).alias("key_values"),
        F.lit(None).cast("string").alias("old_values"),
        _image(row).alias("new_values"),
        (ntz_lit(change_date) if change_date else F.localtimestamp()).alias("change_date"),
        (F.lit(changed_by) if changed_by else F.current_user()).alias("changed_by"),
    )


def with_log_ids(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Number log rows by table, key, operation (distributed, no global window)."""
    return with_surrogate_key(changes, ["table_name", *keys, "operation"], "log_id")


def split_log(changes_with_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The header table and the values table, linked by ``log_id``."""
    log = changes_with_ids.select(*LOG_COLS)
    values = changes_with_ids.select(
        F.col("log_id").alias("log_values_id"), "log_id", "old_values", "new_values"
    )
    return log, values
