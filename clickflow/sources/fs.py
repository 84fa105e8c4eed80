"""Hadoop FileSystem helpers (existence, delete, empty marker) for any Spark path:
local, HDFS or object stores. Metadata operations on the driver only."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.delete(p, True))


def touch(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.create(p, True).close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that must not be there yet (``FileExistsError`` if it is). The
    create is exclusive, so of two writers one fails."""
    p, fs = _path(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as ex:  # noqa: BLE001 - the gateway's exception names the Java class in its text
        if fs.exists(p):
            raise FileExistsError(path) from ex
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was last written, by this machine's clock."""
    p, fs = _path(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0


def usage(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Files below a folder, their bytes, and the folder's time of change."""
    p, fs = _path(spark, path)
    all_of = fs.getContentSummary(p)
    return all_of.getFileCount(), all_of.getLength(), fs.getFileStatus(p).getModificationTime()


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move a file or folder to a place that must not be there yet (its parent is made)."""
    p, fs = _path(spark, src)
    q, _ = _path(spark, dst)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise OSError(f"could not move {src} to {dst}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (none when it is absent)."""
    p, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, None when absent."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
