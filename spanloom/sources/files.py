"""File system calls through Hadoop, so that any file system Spark reads works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly below a path; hidden ones are left out."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of everything directly below a path but hidden entries."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a pattern with ``*``."""
    fs, p = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def listed(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Parquet files below some folders: ``path``, ``length`` and the folders' partition columns.

    Spark lists them, in parallel if there are many folders; none is opened.
    """
    reader = spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", "*.parquet")
    return reader.load(paths).drop("content", "modificationTime")


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Parquet files below a path, with their sizes."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return {}
    found = {}
    listing = fs.listFiles(p, True)
    while listing.hasNext():
        status = listing.next()
        name = status.getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")):
            found[status.getPath().toString()] = status.getLen()
    return found


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether any Parquet file lies below a path; stops at the first one."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return False
    listing = fs.listFiles(p, True)
    while listing.hasNext():
        name = listing.next().getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")):
            return True
    return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing one of that name."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small text file in place, whole or not at all; False if the name is taken.

    A file system with renames moves a finished file there; a local one links it, as its
    renames replace. Object stores need conditional writes for this to hold.
    """
    fs, p = _path(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    source = _path(spark, draft)[1]
    try:
        if fs.getScheme() != "file":
            return not fs.exists(p) and fs.rename(source, p)
        nio = spark._jvm.java.nio.file
        spot = [nio.Paths.get(x.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)) for x in (p, source)]
        nio.Files.createLink(*spot)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(source, False)
