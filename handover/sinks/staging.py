"""Bulk staging writes: the extract lands as whole tables, checked in the pass that writes it.

Each row gets the list of declared constraints that it breaks by itself (NOT
NULL, length). Rows with a breach go to a folder of their own in the same
job, and the number of breaches of each rule is observed while writing, so the
source is read once and nothing is read again to know that all is well. Repeated
keys are found afterwards from the key column of the written copy.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from handover.operators.quality import MAX_LENGTH_RULE, NOT_NULL_RULE, PRIMARY_KEY_RULE, ConstraintViolation, with_quality_columns
from handover.operators.sizing import measured
from handover.schemas import MAX_LENGTHS, NOT_NULL, SOURCE_KEYS, SOURCE_SCHEMAS
from handover.sources.tables import conform

MODES = ("report", "fail", "quarantine")
BREACHED = "breached"  # the folder of rows with a breach of their own


def stage(df: DataFrame, table: str, load_ts: dt.datetime) -> DataFrame:
    """Conform an extract to its declared schema and add the quality columns."""
    return with_quality_columns(conform(df, SOURCE_SCHEMAS[table], table), load_ts)


def write_staging(tables: dict[str, DataFrame], root: str, load_ts: dt.datetime, mode: str = "append") -> dict[str, str]:
    """Write each staged table under ``root/<table>``, keeping the source ids."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/stage_{name}"
        stage(df, name, load_ts).write.mode(mode).parquet(path)
        paths[name] = path
    return paths


@dataclass
class Staged:
    """A staged table: the rows to load, the rows set aside, and what is wrong with them."""

    clean: DataFrame
    quarantined: DataFrame
    violations: DataFrame  # table_name, key_value, column_name, rule
    rows: int
    breaches: dict[tuple[str, str], int]  # (column, rule) -> rows, as observed


def _rules(table: str) -> list[tuple[str, str, Column]]:
    rules = [(c, NOT_NULL_RULE, F.col(c).isNull()) for c in NOT_NULL.get(table, [])]
    return rules + [(c, MAX_LENGTH_RULE, F.length(c) > n) for c, n in MAX_LENGTHS.get(table, {}).items()]


def write_checked(df: DataFrame, table: str, path: str, load_ts: dt.datetime, mode: str = "report") -> Staged:
    """Write one staged table to ``path`` and say what its constraints find.

    ``"report"``: all rows are to be loaded. ``"fail"``: raises on any breach; the
    copy written is not part of a committed run. ``"quarantine"``: rows with a
    breach are set aside, of a repeated key all.
    """
    if mode not in MODES:
        raise ValueError(f"on_violation: {mode!r}")
    key, rules = SOURCE_KEYS[table], _rules(table)
    spark = df.sparkSession
    found = F.filter(F.array(*(F.when(bad, F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"))) for c, r, bad in rules)), lambda x: x.isNotNull())
    obs = Observation(f"staged_{table}")
    counts = [F.count_if(bad).alias(f"{c}|{r}") for c, r, bad in rules]
    rows = stage(df, table, load_ts).observe(obs, F.count(F.lit(1)).alias("rows"), *counts)
    rows = rows.withColumn("breaches", found).withColumn(BREACHED, (F.size("breaches") > 0).cast("int"))
    rows.write.mode("overwrite").partitionBy(BREACHED).parquet(path)
    seen = dict(obs.get)
    n = int(seen.pop("rows"))
    breaches = {tuple(k.split("|")): int(v) for k, v in seen.items() if v}
    read = spark.read.schema(rows.schema).parquet(path)
    keys = read.select(key).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())
    repeated = measured(keys.select(key), f"repeated-{table}")
    if mode == "fail" and (breaches or not repeated.isEmpty()):
        raise ConstraintViolation(f"{table}: constraint violations found; nothing committed")
    own = read.where(F.col(BREACHED) == 1).select(F.col(key).cast("string").alias("key_value"), F.explode("breaches").alias("b"))
    violations = own.select(F.lit(table).alias("table_name"), "key_value", "b.column_name", "b.rule").unionByName(
        repeated.select(
            F.lit(table).alias("table_name"), F.col(key).cast("string").alias("key_value"), F.lit(key).alias("column_name"), F.lit(PRIMARY_KEY_RULE).alias("rule")
        )
    )
    cols = [c for c in rows.columns if c not in ("breaches", BREACHED)]
    if mode != "quarantine":
        return Staged(read.select(*cols), read.limit(0).select(*cols), violations, n, breaches)
    mark = repeated.select(F.col(key).alias("__key"))
    same = read[key].eqNullSafe(mark["__key"])
    fine = read.where(F.col(BREACHED) == 0)
    clean = fine.join(mark, same, "left_anti").select(*cols)
    aside = read.where(F.col(BREACHED) == 1).select(*cols).unionByName(fine.join(mark, same, "left_semi").select(*cols))
    return Staged(clean, aside, violations, n, breaches)
