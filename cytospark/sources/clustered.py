"""SK1, SC2: a dataset stored by cell, so that work by cell reads it without a shuffle.

``expr``, ``obs`` and ``edges`` are bucketed by cell (``edges`` by its ``src``) into the same number of
buckets, one sorted file a bucket and layer. Library sizes, normalising and joins by cell then
need no exchange, and some cells, or a range of them, are found by their buckets and by the
statistics of row groups. ``gene_stats`` holds each gene's sums, which selections start from.

Buckets are known to the catalog alone, so a small file beside the tables holds what it takes to name
them to the catalog of any later session. A name belongs to one writing at one path and never
to another, so a table that is still read can't change its meaning.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import Dataset
from .store import exists, get_text, put_text, whole_path

LAYOUT, GENE_STATS = "_layout.json", "gene_stats"
#: Cells of a bucket, at some thousand values each, and the most buckets that Spark takes.
CELLS_PER_BUCKET, MOST_BUCKETS = 16384, 100_000
#: Bytes of a row group before compression: what the least slice reads.
ROW_GROUP_BYTES = 16 << 20
#: Column by which each table is bucketed, and the order within a bucket.
BUCKETED = {"expr": ("cell_id", ("cell_id", "gene")), "obs": ("cell_id", ("cell_id",)), "edges": ("src", ("src", "dst"))}


def _name(path: str, written: str, table: str) -> str:
    return f"cytospark_{hashlib.sha256(f'{path}|{written}'.encode()).hexdigest()[:20]}_{table}"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "`" for n in names)


def write_clustered(data: Dataset, path: str, buckets: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Write ``data`` by cell to a path where nothing is; without ``buckets`` their number follows the cells'.

    All rows are kept: null ids share a bucket, repeated cells and values lie side by side, a
    table without rows has no files. The layout is written last; without it the tables are read as plain ones.
    """
    spark = data.obs.sparkSession
    path = whole_path(spark, path)
    if exists(spark, path) and any(exists(spark, f"{path}/{t}") for t in (*BUCKETED, "var", LAYOUT)):
        raise FileExistsError(path)
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(spark.sparkContext.defaultParallelism, data.obs.count() // CELLS_PER_BUCKET + 1))
    written, columns = uuid.uuid4().hex, {}
    for table, (by, order) in BUCKETED.items():
        df = getattr(data, table)
        if df is None:
            continue
        # Spark deals rows to tasks as it does to buckets, so each task holds one bucket whole.
        out = df.repartition(buckets, by).write.format("parquet").option("path", f"{path}/{table}").option("parquet.block.size", row_group_bytes)
        out = out.partitionBy("layer") if table == "expr" else out
        out.bucketBy(buckets, by).sortBy(*order).saveAsTable(_name(path, written, table))
        columns[table] = [[f.name, f.dataType.simpleString()] for f in df.schema]
    data.var.write.parquet(f"{path}/var")
    if data.levels is not None:
        data.levels.write.parquet(f"{path}/levels")
    gene_sums(_table(spark, path, {"written": written, "buckets": buckets, "columns": columns}, "expr")).write.parquet(f"{path}/{GENE_STATS}")
    put_text(spark, f"{path}/{LAYOUT}", json.dumps({"written": written, "buckets": buckets, "columns": columns}, indent=1))


def gene_sums(expr: DataFrame) -> DataFrame:
    """Per layer and gene: stored values, their least and greatest, sum and sum of squares."""
    v = F.col("value")
    return expr.groupBy("layer", "gene").agg(F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("greatest"), F.sum(v).alias("s1"), F.sum(v * v).alias("s2"))


def _table(spark: SparkSession, path: str, layout: dict, table: str) -> DataFrame:
    """The bucketed table, named to this session's catalog if it isn't yet."""
    name, (by, order), columns = _name(path, layout["written"], table), BUCKETED[table], layout["columns"][table]
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"{_quoted([c])} {t}" for c, t in columns)
        layers = "PARTITIONED BY (layer)" if table == "expr" else ""
        where = f"{path}/{table}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet {layers} CLUSTERED BY ({_quoted([by])}) SORTED BY ({_quoted(order)}) INTO {layout['buckets']} BUCKETS LOCATION '{where}'")
        if table == "expr":
            spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*(F.col(_quoted([c])) for c, _ in columns))


def read_layout(spark: SparkSession, path: str) -> dict | None:
    """What names the tables at ``path`` to a catalog; None where they aren't stored by cell."""
    return json.loads(get_text(spark, f"{path}/{LAYOUT}")) if exists(spark, f"{path}/{LAYOUT}") else None


def read_clustered(spark: SparkSession, path: str, layout: dict) -> Dataset:
    path = whole_path(spark, path)
    tables = {t: _table(spark, path, layout, t) for t in layout["columns"]}
    levels = spark.read.parquet(f"{path}/levels") if exists(spark, f"{path}/levels") else None
    return Dataset(tables["expr"], tables["obs"], spark.read.parquet(f"{path}/var"), tables.get("edges"), levels)


def stored_moments(stats: DataFrame, n_cells: int, layer: str) -> DataFrame:
    """AG19 from ``gene_stats``: mean and variance (n - 1) of each gene with values, without reading them."""
    n = F.lit(float(n_cells))
    mean = F.col("s1") / n
    var = (F.col("s2") - n * mean * mean) / (n - 1)
    return stats.filter(F.col("layer") == layer).select("gene", mean.alias("mean"), F.greatest(var, F.lit(0.0)).alias("variance"))
