"""SK1: changing a dataset in place. Each version is a folder of its own, and one small file says which holds.

A version is written whole before the file is replaced in one step, so a run that
dies at any point leaves the dataset as it was or as it shall be. What is left behind is in no
version that holds and goes with the next commit. The version before the current one stays until
then, for those that are still reading it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from .store import exists, get_text, put_text, remove

POINTER, PREFIX = "_current", "v-"


def _store(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> str:
    """Folder that holds the tables of the dataset at ``path``: that of the version that counts, or ``path`` itself where there are no versions."""
    if not exists(spark, f"{path}/{POINTER}"):
        return path
    return f"{path}/{get_text(spark, f'{path}/{POINTER}').strip()}"


def _point(spark: SparkSession, path: str, name: str) -> None:
    """Replace the pointer in one step."""
    staged = f"{path}/{POINTER}-{uuid.uuid4().hex}"
    put_text(spark, staged, name)
    jvm, where, _ = _store(spark, staged)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.org.apache.hadoop.fs.Path(path).toUri(), conf) if "://" in path else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    context.rename(where, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), options)


def commit(spark: SparkSession, write: Callable[[str], None], path: str) -> str:
    """``write`` a new version of the dataset at ``path`` from whatever it reads, that path's own tables too, and let it hold.

    Returns the folder of the version. Of two commits at once the later one holds.
    """
    before = current(spark, path)
    name = f"{PREFIX}{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    _point(spark, path, name)
    _, where, fs = _store(spark, path)
    keep = {name, before.rsplit("/", 1)[-1], POINTER} | (set() if before != path else {"expr", "obs", "var", "edges", "levels", "gene_stats", "_layout.json"})
    for entry in fs.listStatus(where):
        if (left := entry.getPath().getName()) not in keep and not left.startswith("."):
            remove(spark, f"{path}/{left}")
    return f"{path}/{name}"
