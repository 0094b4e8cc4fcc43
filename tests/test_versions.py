"""In-place changes that die at any step leave a dataset that can be read; gene lists as they are compared; profiles of wide tables."""

import pytest
from pyspark.sql import functions as F

from cytospark.cli import main
from cytospark.model import Dataset
from cytospark.operators import aggregates as ag
from cytospark.sources import versions
from cytospark.sources.files import read_compared_list, read_dataset, var_names


@pytest.fixture
def data(spark):
    e = spark.createDataFrame([("X", f"c{i}", "g", float(i + 1)) for i in range(3)], "layer string, cell_id string, gene string, value double")
    obs = spark.createDataFrame([(f"c{i}", i) for i in range(3)], "cell_id string, cell_ord long")
    return Dataset(e, obs, spark.createDataFrame([("g", 0)], "gene string, gene_ord long"))


def total(spark, path):
    return read_dataset(spark, path).expr.agg(F.sum("value")).first()[0]


def test_a_commit_that_dies_leaves_the_dataset(spark, data, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    data.write(path)
    (tmp_path / "x.old").mkdir()
    twice = lambda: read_dataset(spark, path).with_(expr=read_dataset(spark, path).expr.withColumn("value", F.col("value") * 2))

    def half(to):
        data.expr.write.partitionBy("layer").parquet(f"{to}/expr")
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        versions.commit(spark, half, path)
    assert total(spark, path) == 6
    versions.commit(spark, twice().write, path)
    assert total(spark, path) == 12
    for step in ("put_text", "_point"):
        with monkeypatch.context() as m:
            m.setattr(versions, step, lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                versions.commit(spark, twice().write, path)
        assert total(spark, path) == 12
    with monkeypatch.context() as m:
        m.setattr(versions, "remove", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            versions.commit(spark, twice().write, path)
    assert total(spark, path) == 24
    held = versions.current(spark, path)
    before = read_dataset(spark, path)
    versions.commit(spark, twice().write, path)
    assert total(spark, path) == 48 and before.expr.count() == 3
    left = sorted(p.name for p in (tmp_path / "x").iterdir() if not p.name.startswith("."))
    assert left == sorted(["_current", held.rsplit("/", 1)[-1], versions.current(spark, path).rsplit("/", 1)[-1]])
    assert [r["gene"] for r in var_names(spark, path).collect()] == ["g"]


def test_commands_in_place(spark, data, tmp_path):
    path = str(tmp_path / "y")
    data.with_(obs=data.obs.withColumn("Subclass", F.lit("s"))).write(path)
    assert main(["columns", path, "--kind", "atlas"]) == 0
    assert "Celltype" in read_dataset(spark, path).obs.columns


def test_compared_lists(spark, tmp_path, capsys):
    (tmp_path / "a_hvg2_k30_hvg_names.txt").write_text("A\nB\nC\nD\n")
    (tmp_path / "a_hvg2_k30_hvg_scores.tsv").write_text("\thighly_variable_rank\nA\t\nB\t1\nC\t0\nD\t2\n")
    (tmp_path / "b_genes.txt").write_text("# names\nB\nC\nE\n")
    first, second = (str(tmp_path / n) for n in ("a_hvg2_k30_hvg_names.txt", "b_genes.txt"))
    assert {r["gene"] for r in read_compared_list(spark, first).collect()} == {"B", "C"}
    assert {r["gene"] for r in read_compared_list(spark, second).collect()} == {"B", "C", "E"}
    assert main(["overlap", first, second]) == 0
    lines = [x.split() for x in capsys.readouterr().out.splitlines() if x.strip()]
    assert lines == [["a_hvg2", "b"], ["a_hvg2", "-", "2", "(100%)(row<col)"], ["b", "2", "(67%)(row>col)", "-"], ["Sizes:"], ["a_hvg2:", "2"], ["b:", "3"]]


def test_profile_of_a_wide_table(spark):
    rows = spark.range(100).select(*(F.when(F.col("id") % 10 > 0, F.col("id") % (i + 1)).alias(f"c{i}") for i in range(50)), F.lit(None).cast("string").alias("none"))
    out = ag.profile(rows, rows.columns)
    got = {r["column"]: r for r in out.collect()}
    for i in range(50):
        values = [x % (i + 1) for x in range(100) if x % 10]
        assert (got[f"c{i}"]["n_unique"], got[f"c{i}"]["n_missing"]) == (len(set(values)), 10)
        listed = got[f"c{i}"]["value_counts"]
        assert (listed is None) == (len(set(values)) > 20) and (listed is None or {r["value"]: r["count"] for r in listed} == {str(v): values.count(v) for v in set(values)})
    assert (got["none"]["n_unique"], got["none"]["n_missing"], got["none"]["value_counts"]) == (0, 100, None)
    assert [r["n_missing"] for r in ag.profile(rows.limit(0), ["c0"]).collect()] == [0]
