"""Staging quality columns, row counts and declared-constraint checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from handover.functions.scalars import ntz_lit
from handover.schemas import MAX_LENGTHS, NOT_NULL, SOURCE_KEYS

# Rule names of the constraint report.
NOT_NULL_RULE = "NOT_NULL"
MAX_LENGTH_RULE = "MAX_LENGTH"
PRIMARY_KEY_RULE = "PRIMARY_KEY"


def with_quality_columns(df: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Staging defaults: valid = true, no error, load time = the run's time."""
    return df.select(
        *[c for c in df.columns if c not in ("is_valid", "validation_error", "load_timestamp")],
        F.lit(True).alias("is_valid"),
        F.lit(None).cast("string").alias("validation_error"),
        ntz_lit(load_ts).alias("load_timestamp"),
    )


def stage_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each staged table, one distributed count each."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def constraint_violations(
    df: DataFrame,
    table: str,
    key: str,
    not_null: list[str] | None = None,
    max_lengths: dict[str, int] | None = None,
    primary_key: str | None = None,
) -> DataFrame:
    """(table_name, key_value, column_name, rule) for every breach.

    NOT NULL and length checks are per-row predicates; the key check is a
    count per key. Keys are nearly all distinct, so they are not combined before
    the shuffle, and go to as many tasks as the session shuffles to: dense keys
    shrink so much when compressed that tasks merged by bytes hold far too many.
    """
    not_null = NOT_NULL.get(table, []) if not_null is None else not_null
    max_lengths = MAX_LENGTHS.get(table, {}) if max_lengths is None else max_lengths
    checks = [(c, NOT_NULL_RULE, F.col(c).isNull()) for c in not_null]
    checks += [(c, MAX_LENGTH_RULE, F.length(F.col(c)) > n) for c, n in max_lengths.items()]
    parts = []
    if checks:
        arr = F.array(
            *[F.when(pred, F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"))) for c, rule, pred in checks]
        )
        parts.append(
            df.select(F.col(key).cast("string").alias("key_value"), F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("v"))
            .select(F.lit(table).alias("table_name"), "key_value", "v.column_name", "v.rule")
        )
    if primary_key:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dup = df.select(primary_key).repartition(tasks, primary_key).groupBy(primary_key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(primary_key).isNull())
        parts.append(
            dup.select(
                F.lit(table).alias("table_name"),
                F.col(primary_key).cast("string").alias("key_value"),
                F.lit(primary_key).alias("column_name"),
                F.lit(PRIMARY_KEY_RULE).alias("rule"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staging_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared staging constraints checked on every staged table."""
    parts = [constraint_violations(df, t, SOURCE_KEYS[t], primary_key=SOURCE_KEYS[t]) for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class ConstraintViolation(ValueError):
    pass


def enforce(df: DataFrame, violations: DataFrame, key: str, mode: str = "fail") -> dict[str, DataFrame]:
    """Apply the constraint report to ``df`` before it is written.

    ``mode="fail"``: raise if any breach exists (an existence probe, not a
    collect), as a failing statement aborts the source run.
    ``mode="quarantine"``: split the rows whose key has a breach from the
    clean rows (a left semi/anti join on the key).
    """
    if mode == "fail":
        if violations.limit(1).count() > 0:
            raise ConstraintViolation("constraint violations found; nothing written")
        return {"clean": df, "quarantined": df.limit(0)}
    if mode != "quarantine":
        raise ValueError(f"mode: {mode!r}")
    keys = violations.select(F.col("key_value").alias("__k")).distinct()
    same = F.col(key).cast("string").eqNullSafe(F.col("__k"))  # a null key is a breach itself
    return {"clean": df.join(keys, same, "left_anti"), "quarantined": df.join(keys, same, "left_semi")}
