"""Shared scratch tables: where lineage is cut and intermediate results are kept.

Everything goes below ``spark.checkpoint.dir``, the one folder that all executors
and the driver share. Where that setting is missing, a session on one machine uses a
temporary folder of its own, and any other one is refused.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession


def shared_root(spark: SparkSession) -> str:
    """URI of the shared scratch folder of this session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = _own_root(spark.sparkContext.applicationId)
    return root.rstrip("/")


@lru_cache(maxsize=None)
def _own_root(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix=f"cytospark-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh URI below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Session setting by which Spark drops an execution's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writes: Counter[str] = Counter()
_before: dict[str, str] = {}


@contextmanager
def _shuffle_files_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when those are done; the setting returns after the last of them."""
    session = f"{spark.sparkContext.applicationId}/{id(spark)}"
    with _lock:
        if not _writes[session]:
            _before[session] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writes[session] += 1
    try:
        yield
    finally:
        with _lock:
            _writes[session] -= 1
            if not _writes[session]:
                spark.conf.set(_CLEANUP, _before.pop(session))


def materialise(df: DataFrame, name: str, watch: Observation | None = None, *sums) -> DataFrame:
    """Write ``df`` to a scratch table and read it back, so later jobs restart from files.

    With ``watch``, the aggregates ``sums`` of the rows written are there afterwards.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffle_files_go(spark):
        (df.observe(watch, *sums) if watch else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of scratch tables that nothing will read again."""
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path:
            spark = table.sparkSession
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
