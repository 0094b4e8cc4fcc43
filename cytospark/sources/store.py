"""Small files and folders in any store that Spark writes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in any store that Spark writes."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    """What ``put_text`` wrote."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(where)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def whole_path(spark: SparkSession, path: str) -> str:
    """``path`` with its store and from its root, as a catalog must have it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def remove(spark: SparkSession, path: str) -> None:
    """SK12: an intermediate result that nothing reads again."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
