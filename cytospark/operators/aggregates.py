"""AG1-AG20 and NK1, NK2: library sizes, group statistics, merges, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.labels import is_whole
from ..model import spread

#: Cell classes whose counts make the total.
MAJORS = ("Ex", "In", "Ast", "Mic", "Oli", "Opc")


def library_sizes(expr: DataFrame) -> DataFrame:
    """AG1."""
    return expr.groupBy("cell_id").agg(F.sum("value").alias("library_size"))


def normalise(expr: DataFrame, target: float, log: bool = True) -> DataFrame:
    """NK1, NK2: ``norm``, each value at a library size of ``target``, by its natural log1p if ``log``.

    One shuffle by cell. A cell whose values sum to 0 is divided by 1.
    """
    total = F.sum("value").over(Window.partitionBy("cell_id"))
    norm = F.col("value") * F.lit(float(target)) / F.when(total == 0, F.lit(1.0)).otherwise(total)
    return expr.withColumn("norm", F.log1p(norm) if log else norm)


def on_every_gene(sums: DataFrame, sizes: DataFrame, genes: DataFrame, keys: Sequence[str], gene: str = "gene") -> DataFrame:
    """(keys, ``gene``, s, c, n_cells): for every group of ``sizes`` and every gene its ``s`` and ``c`` in ``sums``, or zeros.

    The rows of a group and gene arise where the gene is: sums meet in one row a gene, and the groups' zeros, an
    array as long as there are groups, are added there. So neither the dense rows nor all
    genes ever travel, and the result is dealt by gene for whatever groups it next.
    """
    row = lambda n, s, c: F.struct(*keys, n.cast("long").alias("n_cells"), s.cast("double").alias("s"), c.cast("long").alias("c"))
    zeros = sizes.agg(F.collect_list(row(F.col("n_cells"), F.lit(0.0), F.lit(0))).alias("zeros"))
    lists = sums.groupBy(F.col(gene).alias("of")).agg(F.collect_list(row(F.lit(None), F.col("s"), F.col("c"))).alias("found"))
    every = genes.select(F.col("gene").alias(gene)).filter(F.col(gene).isNotNull()).distinct()
    both = every.join(lists, F.col(gene) == F.col("of"), "left").join(F.broadcast(zeros))
    rows = both.select(gene, F.inline(F.when(F.col("found").isNull(), F.col("zeros")).otherwise(F.concat("found", "zeros"))))
    return rows.groupBy(*keys, gene).agg(F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("n_cells").alias("n_cells"))


def group_stats(lognorm: DataFrame, obs: DataFrame, genes: DataFrame, keys: Sequence[str], dense: bool = True) -> DataFrame:
    """AG2, AG3: mean of ``norm`` and share of cells above 0 per group and gene.

    Cells are counted in ``obs``, so zeros and all-zero cells count. ``dense`` emits every
    gene for every group.
    """
    keys = list(keys)
    sizes = obs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_cells"))
    sums = (
        lognorm.join(obs.select("cell_id", *keys), "cell_id")
        .groupBy(*keys, "gene")
        .agg(F.sum("norm").alias("s"), F.count_if(F.col("value") > 0).alias("c"))
    )
    if dense:
        out = on_every_gene(sums, sizes, genes, keys)
    else:
        match = [F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        out = sizes.alias("g").join(sums.alias("s"), match).select(*(F.col(f"g.{k}") for k in keys), "gene", "s", "c", "n_cells")
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("n_cells")
    return out.select(*keys, "gene", share("s").alias("mean_expr"), share("c").alias("frac_expressed"), "n_cells")


def two_granularities(lognorm: DataFrame, obs: DataFrame, donor: str, subtype: str, major: str, tasks: int | None = None) -> DataFrame:
    """AG4, AG5: sums by (donor, subtype) and by (donor, major) in one pass.

    With ``tasks`` the values are dealt by donor and gene before each counts twice, so both sums are whole where they are.
    """
    rows = lognorm.join(obs.select("cell_id", donor, subtype, major), "cell_id").select(donor, subtype, major, "gene", "norm", "value")
    kinds = F.inline(F.array(*(F.struct(F.lit(name).alias("granularity"), F.col(c).alias("cell_type")) for name, c in (("subtype", subtype), ("major", major)))))
    twice = spread(rows, tasks and 2 * tasks, donor, "gene").select(F.col(donor), kinds, "gene", "norm", "value")
    out = twice.groupBy(donor, "granularity", "cell_type", "gene").agg(F.sum("norm").alias("sum_norm"), F.count_if(F.col("value") > 0).alias("n_expressing"))
    return out.select(F.col(donor).cast("string").alias("donor_id"), "granularity", "cell_type", "gene", "sum_norm", "n_expressing")


def merge_stats(stats: DataFrame, keys: Sequence[str] = ("donor_id", "granularity", "cell_type", "gene_symbol")) -> DataFrame:
    """AG6: partial statistics to final ones, weighted by cells. Associative, so it can run by file."""
    n = F.sum("n_cells")
    return stats.groupBy(*keys).agg(
        (F.sum(F.col("n_cells") * F.col("mean_expr").cast("double")) / n).alias("mean_expr"),
        (F.sum(F.col("n_cells") * F.col("frac_expressed").cast("double")) / n).alias("frac_expressed"),
        n.alias("n_cells"),
    )


def donor_counts(cells: DataFrame, donor: str, major: str, majors: Sequence[str] = MAJORS) -> DataFrame:
    """AG7, JO3: cells per donor and class by one pivot of given values; absent ones are 0."""
    counts = cells.groupBy(F.col(donor).cast("string").alias("donor_id"), F.col(major).alias("cell_type")).agg(F.count(F.lit(1)).alias("n_cells"))
    return counts_by_class(counts, majors)


def counts_by_class(counts: DataFrame, majors: Sequence[str] = MAJORS) -> DataFrame:
    """JO3: (donor_id, cell_type, n_cells) with a column a class and their sum; absent ones are 0."""
    wide = counts.groupBy("donor_id").pivot("cell_type", list(majors)).agg(F.sum("n_cells"))
    wide = wide.select("donor_id", *(F.coalesce(F.col(m), F.lit(0)).alias(f"n_cells_{m}") for m in majors))
    total = sum((F.col(f"n_cells_{m}") for m in majors[1:]), F.col(f"n_cells_{majors[0]}"))
    return wide.withColumn("total_cells", total)


def counts_from_stats(stats: DataFrame) -> DataFrame:
    """AG9: cells per donor and class, back from written statistics."""
    return stats.filter(F.col("granularity") == "major").groupBy("donor_id", "cell_type").agg(F.min("n_cells").alias("n_cells"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """AG11: without missing values."""
    return df.filter(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame, columns: Sequence[str], max_categories: int = 20) -> DataFrame:
    """AG13: one row per column: type, distinct and missing values, and counts if the values are few.

    Rows are unpivoted and counted by (column, value), each task first by itself: one shuffle however many
    columns there are, of which both the numbers and the lists are made. Values are told apart as text.
    """
    kinds = dict(df.dtypes)
    pairs = F.array(*(F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)))
    counts = df.select(F.inline(pairs)).groupBy("at", "value").count()
    head = counts.groupBy("at").agg(F.count("value").alias("n_unique"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("count"))), F.lit(0)).alias("n_missing"))
    few = counts.filter("value is not null").join(head.filter(F.col("n_unique") <= max_categories).select("at"), "at", "left_semi")
    lists = few.groupBy("at").agg(F.sort_array(F.collect_list(F.struct("value", "count"))).alias("value_counts"))
    names = df.sparkSession.createDataFrame([(i, c, kinds[c]) for i, c in enumerate(columns)], "at int, column string, type string")
    out = names.join(head, "at", "left").join(lists, "at", "left")
    return out.select("column", "type", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("n_unique", "n_missing")), "value_counts")


def matrix_profile(expr: DataFrame, n_cells: int, n_genes: int) -> DataFrame:
    """AG14: of the stored values; sparsity of the whole matrix."""
    return expr.agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
        F.stddev_pop("value").alias("std_value"),
        F.count("value").alias("nnz"),
        (1 - F.count("value") / F.lit(float(n_cells) * n_genes)).alias("sparsity"),
    )


def inspect_layers(expr: DataFrame, n_cells: int | None = None, n_genes: int | None = None) -> DataFrame:
    """AG17: what the positive values of each layer look like; with both sizes also their ``density``."""
    v = F.col("value")
    out = expr.filter(v > 0).groupBy("layer").agg(F.count(v).alias("n"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"), (100 * F.avg(is_whole(v).cast("int"))).alias("pct_whole"))
    if n_cells and n_genes:
        out = out.withColumn("density", F.col("n") / F.lit(float(n_cells) * n_genes))
    return out.withColumn("looks_like", F.when(F.col("pct_whole") > 99, "counts").when(F.col("max_value") < 20, "log-normalised").otherwise("ambiguous"))


def gene_moments(expr: DataFrame, n_cells: int, value: str = "value") -> DataFrame:
    """AG19: mean and variance (n - 1) of each gene over all cells, by sums of non-zeros."""
    v, n = F.col(value), F.lit(float(n_cells))
    sums = expr.groupBy("gene").agg(F.sum(v).alias("s1"), F.sum(v * v).alias("s2"))
    mean = F.col("s1") / n
    var = (F.col("s2") - n * mean * mean) / (n - 1)
    return sums.select("gene", mean.alias("mean"), F.greatest(var, F.lit(0.0)).alias("variance"))
