"""Small files and listings read by the driver without a Spark job.

Through the file system that Spark itself uses, so any path that a reader
takes will do.  For headers, manifests and lists of files only: data are read
by the executors.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _path(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _path(spark, path)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file; null for an empty one."""
    fs, where = _path(spark, path)
    jvm = spark._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(where), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def matching(spark: SparkSession, paths) -> list[str]:
    """Data files of paths or globs; a directory stands for the files in it."""
    out = []
    for pattern in [paths] if isinstance(paths, str) else paths:
        fs, where = _path(spark, pattern)
        for status in fs.globStatus(where) or ():
            inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [s.getPath().toString() for s in inner
                    if not s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]
    return sorted(out)
