"""The scalar helpers as SQL functions, for users who write ``spark.sql``.

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` defines a SQL function that
Catalyst inlines into the calling plan (whole-stage codegen, no Python), the
Spark form of the source's scalar user function. The bodies mirror the
Column helpers in ``scalars.py``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_TRIMMED = "trim(coalesce(name, ''))"

SQL_FUNCTIONS: dict[str, str] = {
    "customer_code": f"""(name STRING) RETURNS STRING RETURN
        CASE WHEN length({_TRIMMED}) > 0
             THEN upper(concat(substring({_TRIMMED}, 1, 1),
                               substring(sha1(encode({_TRIMMED}, 'UTF-16LE')), 1, 4))) END""",
    "parse_money": r"""(txt STRING, mark STRING) RETURNS DECIMAL(19,4) RETURN
        CASE WHEN regexp_replace(trim(replace(txt, coalesce(mark, ''), '')), ',', '') RLIKE '^[+-]?(\\d+\\.?\\d*|\\.\\d+)$'
             THEN try_cast(regexp_replace(trim(replace(txt, coalesce(mark, ''), '')), ',', '') AS DECIMAL(19,4)) END""",
    "parse_percent_int": r"""(txt STRING) RETURNS INT RETURN
        CASE WHEN trim(replace(txt, '%', '')) RLIKE '^[+-]?\\d+$'
             THEN try_cast(trim(replace(txt, '%', '')) AS INT) END""",
    "epoch_digits_to_ts": """(n BIGINT) RETURNS TIMESTAMP_NTZ RETURN
        timestampadd(SECOND, CAST(substring(CAST(n AS STRING), 1, 10) AS INT), TIMESTAMP_NTZ'1970-01-01 00:00:00')""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the helpers as temporary SQL functions in this session."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(SQL_FUNCTIONS)
