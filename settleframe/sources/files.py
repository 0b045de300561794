"""Small file-system helpers on the driver, through the Hadoop file system of the
session, so any store that Spark reads works: renames and deletes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder that Spark wrote holds any data file."""
    p, fs = _fs(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, if there is one."""
    p, fs = _fs(spark, path)
    if fs.exists(p) and not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be moved to {to}")


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)
