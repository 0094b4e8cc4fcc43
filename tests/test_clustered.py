"""A dataset stored by cell: same rows, no exchange for work by cell, few row groups for a slice, later sessions and moved folders."""

import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cytospark.cli import main
from cytospark.model import Dataset
from cytospark.operators import aggregates as ag
from cytospark.sources.clustered import GENE_STATS, stored_moments, write_clustered
from cytospark.sources.files import read_dataset, var_names
from cytospark.sources.versions import current

CELLS, GENES, BUCKETS = 240, 30, 6


@pytest.fixture
def data(spark):
    e = spark.range(CELLS * GENES).select(
        F.lit("X").alias("layer"), F.concat(F.lit("c"), (F.col("id") / GENES).cast("int")).alias("cell_id"), F.concat(F.lit("g"), F.col("id") % GENES).alias("gene"), (F.col("id") % 7 + 1).cast("double").alias("value")
    )
    e = e.unionByName(e.filter("gene = 'g3'").withColumn("layer", F.lit("raw")))
    obs = spark.range(CELLS).select(F.concat(F.lit("c"), "id").alias("cell_id"), F.col("id").alias("cell_ord"), (F.col("id") % 5).alias("a donor"))
    var = spark.range(GENES).select(F.concat(F.lit("g"), "id").alias("gene"), F.col("id").alias("gene_ord"))
    edges = obs.select(F.col("cell_id").alias("src"), F.concat(F.lit("c"), (F.col("cell_ord") + 1) % CELLS).alias("dst"), F.lit(0.5).alias("weight"))
    return Dataset(e, obs, var, edges)


def rows(df):
    return sorted(repr([(c, r[c]) for c in sorted(df.columns)]) for r in df.collect())


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, data, tmp_path):
    path = str(tmp_path / "it's here")
    write_clustered(data, path, BUCKETS)
    return path


def test_same_rows(spark, data, stored):
    got = read_dataset(spark, stored)
    for t in ("expr", "obs", "var", "edges"):
        assert getattr(got, t).columns == getattr(data, t).columns and rows(getattr(got, t)) == rows(getattr(data, t))
    assert var_names(spark, stored).count() == GENES
    with pytest.raises(FileExistsError):
        write_clustered(data, stored, BUCKETS)


def test_no_exchange(spark, data, stored, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = read_dataset(spark, stored)
        main_layer = x.expr.filter("layer = 'X'")
        norm = ag.normalise(main_layer, 1e4)
        joined = norm.join(x.obs, "cell_id").select("cell_id", "gene", "norm", "a donor")
        for df in (ag.library_sizes(main_layer), norm, joined, x.obs.join(x.edges, F.col("cell_id") == F.col("src"))):
            assert "Exchange" not in plan(df)
        assert "Exchange" in plan(ag.library_sizes(data.expr))
        assert rows(norm.withColumn("norm", F.round("norm", 9))) == rows(ag.normalise(data.expr.filter("layer = 'X'"), 1e4).withColumn("norm", F.round("norm", 9)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_slice_reads_little(spark, data, tmp_path):
    path = str(tmp_path / "small")
    write_clustered(data, path, BUCKETS, row_group_bytes=2048)
    one = read_dataset(spark, path).expr.filter("layer = 'X' and cell_id = 'c17'")
    assert one.count() == len(one.collect()) == GENES
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = {n: scan.metrics().apply(n).value() for n in ("numFiles", "numOutputRows")}
    assert read["numFiles"] <= BUCKETS and read["numOutputRows"] < CELLS * GENES / BUCKETS
    files = list((tmp_path / "small" / "expr" / "layer=X").glob("*.parquet"))
    assert len(files) == BUCKETS
    for f in files:
        cells = pq.read_table(f)["cell_id"].to_pylist()
        assert cells == sorted(cells)


def test_gene_statistics(spark, data, stored):
    got = stored_moments(spark.read.parquet(f"{stored}/{GENE_STATS}"), CELLS, "X")
    assert rows(got) == rows(ag.gene_moments(data.expr.filter("layer = 'X'"), CELLS))


def test_another_session_and_a_moved_folder(spark, data, stored, tmp_path):
    other = str(tmp_path / "moved")
    shutil.copytree(stored, other)
    for t in spark.catalog.listTables():
        if t.name.startswith("cytospark_"):
            spark.sql(f"DROP TABLE {t.name}")
    shutil.move(stored, stored + "-gone")
    x = read_dataset(spark.newSession(), other)
    assert rows(x.expr) == rows(data.expr) and "Exchange" not in plan(ag.library_sizes(x.expr))


def test_odd_cells_and_empty_tables(spark, data, tmp_path):
    odd = spark.createDataFrame([("X", None, "g1", 2.0), ("X", None, "g1", 2.0), ("X", "", None, 1.0), ("X", "c1", "g1", None)], "layer string, cell_id string, gene string, value double")
    given = data.with_(expr=odd, obs=data.obs.limit(0), edges=data.edges.limit(0))
    write_clustered(given, str(tmp_path / "odd"))
    got = read_dataset(spark, str(tmp_path / "odd"))
    assert rows(got.expr) == rows(odd) and got.obs.count() == 0 and got.edges.count() == 0
    none = data.with_(expr=odd.limit(0), obs=data.obs.limit(0), edges=None)
    write_clustered(none, str(tmp_path / "none"), 2)
    got = read_dataset(spark, str(tmp_path / "none"))
    assert got.expr.count() == 0 and got.edges is None and spark.read.parquet(f"{tmp_path}/none/{GENE_STATS}").count() == 0


def test_commands_keep_the_store(spark, data, tmp_path):
    path = str(tmp_path / "x")
    data.with_(obs=data.obs.withColumn("Subclass", F.lit("s"))).write(path)
    before = read_dataset(spark, path)
    assert main(["store", path, "--buckets", "3"]) == 0
    assert "Exchange" not in plan(ag.library_sizes(read_dataset(spark, path).expr)) and before.expr.count() == data.expr.count()
    first = current(spark, path)
    assert main(["columns", path, "--kind", "atlas"]) == 0
    x = read_dataset(spark, path)
    assert current(spark, path) != first and "Celltype" in x.obs.columns and rows(x.expr) == rows(data.expr)
    assert "Exchange" not in plan(ag.library_sizes(x.expr))
    assert main(["store", path, str(tmp_path / "y")]) == 0 and rows(read_dataset(spark, str(tmp_path / "y")).obs) == rows(x.obs)
