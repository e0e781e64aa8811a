"""Small files that exist once: the commit points of jobs that may run twice.

``put_once`` makes a file with its content in one step, or finds that another
writer was first. On a local path (the driver's own disk or a mounted share) a
written temporary file is linked to the name, which fails if the name exists.
Elsewhere the temporary file is renamed by the Hadoop file system, which on HDFS
fails likewise. A store without an atomic rename needs its own committer.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _local(path: str) -> str | None:
    """The plain path of a local name, else None. Bare paths follow the session's default file system."""
    return path[5:].replace("//", "", 1) if path.startswith("file:") else None


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, fs.makeQualified(p)


def _resolve(spark: SparkSession, path: str):
    fs, p = _hadoop(spark, path)
    return fs, p, _local(p.toString())


def put_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Make the file ``path`` with ``text``; False if it exists already. Of several writers one gets True."""
    fs, p, local = _resolve(spark, path)
    if local is not None:
        folder, name = os.path.split(local)
        os.makedirs(folder, exist_ok=True)
        part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")  # names with a dot are no data to Spark's readers
        with open(part, "x") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(part, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(part)
    part = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    fs.mkdirs(p.getParent())
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(p) and fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the finished files in ``folder``, sorted; none if there is no such folder."""
    fs, p, local = _resolve(spark, folder)
    if local is not None:
        found = os.listdir(local) if os.path.isdir(local) else []
    else:
        found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith("."))


def text_of(spark: SparkSession, path: str) -> str | None:
    """Content of a marker, None if it isn't there."""
    fs, p, local = _resolve(spark, path)
    if local is not None:
        if not os.path.exists(local):
            return None
        with open(local) as f:
            return f.read()
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
