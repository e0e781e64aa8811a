"""Compare each registered Spark query with its DuckDB oracle (rows, columns, values)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("EXACT_FLOATS") else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = list(rel.columns)
    dtypes = dict(zip(dcols, map(str, rel.types)))
    drows = rel.fetchall()
    t2 = time.time()
    s_sorted, scols = rows_of(df.columns, srows)
    d_sorted, dcols_s = rows_of(dcols, drows)
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    type_diff = {c: (stypes.get(c), dtypes.get(c)) for c in dcols if stypes.get(c) != dtypes.get(c)}
    ok = scols == dcols_s and s_sorted == d_sorted and not type_diff
    info = f"{name}: spark {len(srows)} rows {t1-t0:.1f}s / duckdb {len(drows)} rows {t2-t1:.1f}s"
    if not ok:
        if type_diff:
            info += f"\n   types differ: {type_diff}"
        if scols != dcols_s:
            info += f"\n   columns differ: {scols} vs {dcols_s}"
        else:
            a, b = set(s_sorted), set(d_sorted)
            info += f"\n   only spark: {list(a - b)[:3]}\n   only duckdb: {list(b - a)[:3]}"
    return ok, info


def main(argv):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from handover.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    if os.environ.get("VANILLA_SESSION"):
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[8]")
            .config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", os.environ.get("SESSION_TZ", "UTC"))
            .getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in sorted(qs):
        if only and name not in only:
            continue
        if name not in sql:
            print(f"{name}: no oracle")
            continue
        try:
            ok, info = compare(spark, name, qs[name], sql[name], sf_dir, con)
        except Exception as e:  # report and continue
            ok, info = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("OK   " if ok else "FAIL ") + info, flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
