"""Steps that sort or add up values are dealt over tasks by their number of rows, not by the session's setting alone."""

import os

import pytest
from pyspark.sql import functions as F
from test_catalog import SF, duck, rows  # noqa: F401

from cytospark import model
from cytospark.operators import combine as cb
from cytospark.plans import catalog

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["concat_inner", "concat_outer", "concat_clashing_cells", "group_stats_grouping_sets"])
def test_many_tasks_give_the_same_rows(spark, duck, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(model, "ROWS_PER_TASK", 500)
    assert rows(catalog.QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(catalog.ORACLE_SQL[name]).df())


def test_values_are_dealt_by_their_number(spark, monkeypatch):
    """a twelfth of the rows a task, though the session says four; genes that stay are looked up, so values aren't sorted by gene."""
    assert catalog.dataset(spark, SF).tasks is None
    lines = catalog.table(spark, SF, "lineitem").count()
    monkeypatch.setattr(model, "ROWS_PER_TASK", -(-lines // 12))
    x = catalog.dataset(spark, SF)
    assert x.tasks == 12 and x.expr.rdd.getNumPartitions() == 12
    both = cb.concat(catalog._halves(spark, SF), join="inner")
    assert both.tasks == 24 and both.expr.rdd.getNumPartitions() == 24
    assert "SortMergeJoin [gene" not in plan(both.expr) and plan(both.expr).count("ShuffledHashJoin [gene") >= 2


def test_a_large_number_of_partitions_is_no_reason_to_merge_values(spark, duck, monkeypatch):  # noqa: F811
    """where the session says 200, Spark would merge them into one a core; values are still dealt by their number."""
    lines = catalog.table(spark, SF, "lineitem").count()
    monkeypatch.setattr(model, "ROWS_PER_TASK", -(-lines // 12))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        out = catalog.QUERIES["concat_outer"](spark, SF)
        sizes = out.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert catalog.dataset(spark, SF).tasks == 12 and out.rdd.getNumPartitions() == 24
        assert len(sizes) == 24 and sizes.max() < lines / 6
        assert rows(out.toPandas()) == rows(duck.sql(catalog.ORACLE_SQL["concat_outer"]).df())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
