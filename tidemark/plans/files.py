"""What the table layer asks of a file system, through Spark's own file systems, so that any of them will do."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.delete(p, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file at a place that nobody has taken; False where someone has.

    Local files are linked into place, which is exclusive; elsewhere the file system's exclusive creation is used.
    """
    p, fs = _fs(spark, path)
    if fs.getScheme() == "file":
        local = p.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = os.path.join(os.path.dirname(local), f".{uuid.uuid4().hex}")
        with open(draft, "w") as f:
            f.write(text)
        try:
            os.link(draft, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
