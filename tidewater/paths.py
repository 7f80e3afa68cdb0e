"""Small driver-side helpers over the Hadoop FileSystem API.

They touch names, marker files and one-object JSON state only.  Row data never
passes through here.  All of them work on any file system Spark can reach.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


# fixed values: schemes of stores that replace an object in one step
OBJECT_STORES = ("s3", "s3a", "gs", "oss", "cosn")


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match the pattern; empty when nothing does."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [str(s.getPath().toString()) for s in found] if found else []


class Usage(NamedTuple):
    bytes: int
    files: int
    folders: int


def usage(spark: SparkSession, path: str) -> Usage:
    """What lies below a path, itself included."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return Usage(0, 0, 0)
    found = fs.getContentSummary(p)
    return Usage(found.getLength(), found.getFileCount(), found.getDirectoryCount())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_json(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Replace the file in one step: a reader sees the old or the new object.

    Object stores show a file once it is closed, and their rename is a copy with a gap;
    there the file is written in place.
    """
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    text = bytearray(json.dumps(value, sort_keys=True).encode("utf-8"))
    if fs.getUri().getScheme() in OBJECT_STORES:
        _put(fs, target, text)
        return
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}"
    )
    _put(fs, draft, text)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(fs.makeQualified(draft), fs.makeQualified(target), overwrite)


def _put(fs, target, text: bytearray) -> None:
    out = fs.create(target, True)
    try:
        out.write(text)
    finally:
        out.close()


def sql_text(value: str) -> str:
    """The value as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
