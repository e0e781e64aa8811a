"""All-or-nothing publishing of a migration run on plain parquet folders.

Every attempt at a run writes its outputs to folders of its own,
``<root>/<table>/run_id=<id>/attempt=<token>``. The commit is one file made once,
``<root>/_runs/<id>``, that names the attempt: of two attempts at one run at the
same time the first to finish is the run, and the other's rows are never seen, as
those of an attempt that failed. Readers read the committed attempts' folders.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from handover.functions.scalars import ntz_lit
from handover.operators.parallel import at_once
from handover.sinks.marker import names, put_once, text_of

RUNS = "_runs"
RUN_LOG = "_run_log"


class RunCommittedError(ValueError):
    """The run id is committed, before this attempt began or by another one since."""


def new_attempt() -> str:
    return uuid.uuid4().hex[:16]


def table_path(root: str, table: str, run_id: str, attempt: str) -> str:
    return f"{root.rstrip('/')}/{table}/run_id={run_id}/attempt={attempt}"


def write_table(df: DataFrame, root: str, table: str, run_id: str, attempt: str = "none") -> None:
    df.write.mode("overwrite").parquet(table_path(root, table, run_id, attempt))


def publish_run(
    spark: SparkSession,
    outputs: dict[str, DataFrame],
    root: str,
    run_id: str,
    finished_at: dt.datetime,
    already_written: dict[str, int] | None = None,
    attempt: str | None = None,
) -> dict[str, int]:
    """Write every output, then commit the run. Raises if another attempt was first.

    Row counts are taken while writing (``DataFrame.observe``: no second pass)
    and logged to ``_run_log``; they are returned as well. Tables listed in
    ``already_written`` were written in place by the run and are only logged.
    """
    refuse_committed(spark, root, run_id)
    attempt = attempt or new_attempt()
    counts: dict[str, int] = dict(already_written or {})

    def write(table: str, df: DataFrame) -> tuple[str, int]:
        obs = Observation(f"rows_{table}")
        write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), root, table, run_id, attempt)
        return table, int(obs.get["rows"])

    # what the run itself has written in place isn't written again
    counts.update(at_once(*(lambda t=t, df=df: write(t, df) for t, df in outputs.items() if t not in counts)))
    base = root.rstrip("/")
    log = spark.createDataFrame(
        [(run_id, attempt, t, n) for t, n in counts.items()], "run_id string, attempt string, table_name string, row_count long"
    ).withColumn("logged_at", ntz_lit(finished_at))
    log.write.mode("append").parquet(f"{base}/{RUN_LOG}")
    marker = {"attempt": attempt, "finished_at": finished_at.isoformat(), "tables": sorted(counts)}
    if not put_once(spark, _marker(base, run_id), json.dumps(marker)):
        raise RunCommittedError(f"run {run_id!r} was committed under {root} by another attempt")
    return counts


def _marker(root: str, run_id: str) -> str:
    if not run_id or "/" in run_id or run_id.startswith("."):
        raise ValueError(f"run id {run_id!r} is no file name")
    return f"{root.rstrip('/')}/{RUNS}/{run_id}"


def _commits(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, dict]:
    """Committed run id -> its marker: one small file for each run."""
    ids = names(spark, f"{root.rstrip('/')}/{RUNS}") if run_id is None else [run_id]
    found = {i: text_of(spark, _marker(root, i)) for i in ids}
    return {i: json.loads(text) for i, text in found.items() if text is not None}


def completed_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, attempt, finished_at, tables) of the committed runs."""
    rows = [(i, m["attempt"], dt.datetime.fromisoformat(m["finished_at"]), ",".join(m["tables"])) for i, m in _commits(spark, root).items()]
    return spark.createDataFrame(rows, "run_id string, attempt string, finished_at timestamp_ntz, tables string")


def refuse_committed(spark: SparkSession, root: str, run_id: str) -> None:
    """Raise if the run id has been committed already."""
    if _commits(spark, root, run_id):
        raise RunCommittedError(f"run {run_id!r} is committed under {root}; use a new run id")


def read_published(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """Rows of committed runs only, with their ``run_id`` (optionally one run)."""
    base = f"{root.rstrip('/')}/{table}"
    paths = [table_path(root, table, i, m["attempt"]) for i, m in _commits(spark, root, run_id).items() if table in m["tables"]]
    reader = spark.read.option("basePath", base)
    # nothing committed: the columns of what is there, without a row
    df = reader.parquet(*paths) if paths else reader.parquet(base).where(F.lit(False))
    return df.withColumn("run_id", F.col("run_id").cast("string")).drop("attempt")
