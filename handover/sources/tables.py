"""Readers: given parquet tables and legacy source extracts with enforced schemas."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from handover.schemas import SOURCE_KEYS, SOURCE_SCHEMAS
from handover.sources.ranges import ROWS_PER_RANGE, cut_points, even_steps, predicates, quote

# Extract order of the legacy tables (parents before children).
SOURCE_ORDER = ("locations", "batches", "entities", "items", "transactions")


class SchemaMismatch(ValueError):
    pass


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided parquet tables (vectorised reader, pushdown, pruning)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def conform(df: DataFrame, schema: StructType, table: str = "") -> DataFrame:
    """Select ``schema``'s columns in order with their declared types.

    Missing or unexpected columns raise: the target insert takes its column
    list from the extract, so an extra column is an error, not something to
    drop silently.
    """
    have = {c.lower() for c in df.columns}
    want = [f.name for f in schema.fields]
    missing = [c for c in want if c.lower() not in have]
    extra = sorted(have - {c.lower() for c in want})
    if missing or extra:
        raise SchemaMismatch(f"{table or 'table'}: missing {missing}, unexpected {extra}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_source(
    spark: SparkSession,
    table: str,
    *,
    path: str | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    schema: StructType | None = None,
) -> DataFrame:
    """Full extract of one legacy table with its declared schema.

    ``path``: parquet extract. ``jdbc_url``: one connection for each range of
    about ``rows_per_range`` keys (``jdbc_ranges``), instead of one connection
    that reads the whole table. ``fetchsize`` is 10,000 unless given.
    """
    schema = schema or SOURCE_SCHEMAS[table]
    if path is not None:
        df = spark.read.parquet(path)
    elif jdbc_url is not None:
        props = {"fetchsize": "10000"} | dict(jdbc_properties or {})
        ranges = jdbc_ranges(spark, table, SOURCE_KEYS[table], jdbc_url, props, rows_per_range)
        df = spark.read.jdbc(jdbc_url, table, predicates=ranges, properties=props)
    else:
        raise ValueError("read_source needs path= or jdbc_url=")
    return conform(df, schema, table)


def jdbc_ranges(spark: SparkSession, table: str, key: str, jdbc_url: str, properties: dict, rows_per_range: int = ROWS_PER_RANGE) -> list[str]:
    """Conditions that cut a table into ranges of about equal numbers of rows.

    The source gives the ends and the number of its keys (one row); the keys
    alone are then read in even steps between the ends, and cut at their
    quantiles. A table that fits one range is read as one.
    """
    column = quote(key)
    ends = spark.read.jdbc(
        jdbc_url, f"(SELECT min({column}) AS low, max({column}) AS high, count(*) AS n FROM {table}) ends", properties=properties
    ).first()
    low, high, n = (ends[c] for c in ("low", "high", "n"))
    if low is None or n <= rows_per_range:
        return predicates(column, [])
    keys = spark.read.jdbc(
        jdbc_url,
        f"(SELECT {column} FROM {table}) keys",
        column=key,
        lowerBound=int(low),
        upperBound=int(high) + 1,
        numPartitions=even_steps(int(low), int(high), n, rows_per_range),
        properties=properties,
    )
    return predicates(column, cut_points(keys, key, rows_per_range), nullable=True)


def read_all_jdbc(
    spark: SparkSession, jdbc_url: str, jdbc_properties: dict | None = None, rows_per_range: int = ROWS_PER_RANGE, tables: Iterable[str] = SOURCE_ORDER
) -> dict[str, DataFrame]:
    """All five legacy tables from a relational source."""
    return {t: read_source(spark, t, jdbc_url=jdbc_url, jdbc_properties=jdbc_properties, rows_per_range=rows_per_range) for t in tables}


def read_all_sources(spark: SparkSession, paths: dict[str, str], tables: Iterable[str] = SOURCE_ORDER) -> dict[str, DataFrame]:
    """All five legacy tables (lazy, so the extract order does not matter)."""
    return {t: read_source(spark, t, path=paths[t]) for t in tables}
