"""Single file operations through Hadoop's file systems, so that any path Spark reads (s3a, hdfs, viewfs, ...) works.

They run on the driver and touch names only, never contents (``copy`` apart)."""
from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of ``path`` and the path in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> set[str]:
    """Names of what stands in ``folder``, none when it does not exist."""
    fs, p = at(spark, folder)
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, p = at(spark, pattern)
    return [f.getPath().toString() for f in fs.globStatus(p) or []]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = at(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = at(spark, source)
    if not fs.rename(p, at(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def copy(spark: SparkSession, source: str, target: str) -> None:
    (a, p), (b, q) = at(spark, source), at(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, p, b, q, False, spark._jsc.hadoopConfiguration())


def move_tree(spark: SparkSession, source: str, target: str, prefix: str = "") -> None:
    """Move the files below ``source`` to the same places below ``target``: folders that are new there as a whole, files of
    others one by one, with ``prefix`` before their names (one task gives its files in all folders the same name)."""
    fs, p = at(spark, source)
    _, q = at(spark, target)
    if not fs.exists(p):
        return
    if not fs.exists(q):
        fs.mkdirs(q.getParent())
        return move(spark, source, target)
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if f.isDirectory():
            move_tree(spark, f"{source}/{name}", f"{target}/{name}", prefix)
        elif not name.startswith(("_", ".")):
            move(spark, f"{source}/{name}", f"{target}/{prefix}{name}")


def redate(spark: SparkSession, paths: list[str], seconds: int) -> None:
    """Set the modification time of files (seconds since 1970), as a copy that keeps times does."""
    for path in paths:
        fs, p = at(spark, path)
        fs.setTimes(p, seconds * 1000, -1)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file's content, None when it does not exist."""
    fs, p = at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written over whatever stands there."""
    fs, p = at(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in one step: written beside and renamed over whatever stands there."""
    beside = f"{path}.{uuid.uuid4().hex[:8]}"
    write_text(spark, beside, text)
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (beside, path))
    _, absolute = at(spark, source.toString())
    uri = source.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(absolute).toUri()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration()).rename(source, target, options)
