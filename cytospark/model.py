"""The matrix as tables: ``expr`` (one row per non-zero), ``obs`` (cells), ``var`` (genes) and perhaps ``edges`` and ``levels``.

expr: layer string, cell_id string, gene string, value double (value <> 0)
obs:  cell_id string, cell_ord bigint, any further columns
var:  gene string, gene_ord bigint, any further columns
edges: src string, dst string, any further columns: a graph whose ends are cells of ``obs``
levels: column string, code bigint, level string, ordered boolean: categories of ``obs`` and their order

Zeros are implicit, so a mean over cells divides by a count from ``obs``, never by the
number of rows in ``expr``.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

#: Layer of the main matrix, and of the unfiltered one.
MAIN, RAW = "X", "raw"

MIN_GENES_PER_CELL = 200
MIN_CELLS_PER_GENE = 5
TOP_GENES = 2000
NEIGHBOURS = 30
#: Cells of a donor above which neighbours are found by descent.
EXACT_CELLS = 8192
COMPONENTS = 50
FEATURE_TARGET = 1e6
AGGREGATE_TARGET = 1e4
#: Values that one task holds in a step that sorts them or adds them up.
ROWS_PER_TASK = 1 << 18


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks over which so many values are dealt, so that a task's share doesn't grow with them; None where one a core is enough.

    The session's number of partitions isn't enough: Spark merges them into one a core, up to its advisory size.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    return tasks if tasks > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism) else None


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over so many tasks; without a number as it is."""
    return df.repartition(tasks, *keys) if tasks else df


def looked_up(df: DataFrame, tasks: int | None) -> DataFrame:
    """The smaller side of a join over so many tasks: it lies in a hash table, and the larger one isn't sorted. Without a number Spark chooses."""
    return df.hint("shuffle_hash") if tasks else df


@dataclass(frozen=True)
class Dataset:
    """One matrix with its annotations. Operators return a new one."""

    expr: DataFrame
    obs: DataFrame
    var: DataFrame
    edges: DataFrame | None = None
    levels: DataFrame | None = None
    #: Tasks over which ``expr`` is dealt where it is shuffled; None: as the session is set.
    tasks: int | None = None

    def with_(self, **changes: DataFrame | int | None) -> Dataset:
        return replace(self, **changes)

    def write(self, path: str, mode: str = "errorifexists") -> None:
        """SK1: one Parquet table each; ``expr`` is partitioned by layer, so a layer scan prunes.

        A path that is being read can't be its own target: write elsewhere and swap.
        """
        self.expr.write.mode(mode).partitionBy("layer").parquet(f"{path}/expr")
        self.obs.write.mode(mode).parquet(f"{path}/obs")
        self.var.write.mode(mode).parquet(f"{path}/var")
        for name, df in (("edges", self.edges), ("levels", self.levels)):
            if df is not None:
                df.write.mode(mode).parquet(f"{path}/{name}")
