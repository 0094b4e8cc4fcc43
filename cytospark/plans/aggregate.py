"""Entry B: statistics per donor, cell type and gene at two granularities, and the donor table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import AGGREGATE_TARGET, MAIN, Dataset
from ..operators.aggregates import MAJORS, counts_by_class, counts_from_stats, merge_stats, normalise, on_every_gene, two_granularities
from ..operators.columns import clinical_columns, counts_last
from ..operators.joins import donor_metadata
from ..operators.report import warn_of_fractions, warn_of_gene_counts
from ..sources.files import read_dataset, read_table, resolve_inputs, write_tsv
from ..sources.runs import summary, write_single, write_summary
from ..sources.store import remove

STATS = "donor_id", "granularity", "cell_type", "gene_symbol", "mean_expr", "frac_expressed", "n_cells"


def class_stats(data: Dataset, major: str, donor: str = "projid", subtype: str = "cell_type_high_resolution") -> DataFrame:
    """AG3-AG5, PR20: one dataset's statistics, dense over its genes, sums of both granularities in one pass.

    A missing donor is a group of its own.
    """
    obs = data.obs.select("cell_id", F.col(donor).cast("string").alias("donor_id"), F.col(subtype).cast("string").alias("subtype"), F.lit(major).alias("major"))
    sums = two_granularities(normalise(data.expr.filter(F.col("layer") == MAIN), AGGREGATE_TARGET), obs, "donor_id", "subtype", "major", data.tasks).withColumnRenamed("gene", "gene_symbol")
    kinds = F.inline(F.array(*(F.struct(F.lit(g).alias("granularity"), F.col(g).alias("cell_type")) for g in ("major", "subtype"))))
    sizes = obs.select("donor_id", kinds).groupBy("donor_id", "granularity", "cell_type").agg(F.count(F.lit(1)).alias("n_cells"))
    keys = ("donor_id", "granularity", "cell_type")
    out = on_every_gene(sums.withColumnsRenamed({"sum_norm": "s", "n_expressing": "c"}), sizes, data.var, keys, "gene_symbol")
    share = lambda c: F.coalesce(F.col(c), F.lit(0)) / F.col("n_cells")
    return out.select(*keys, "gene_symbol", share("s").alias("mean_expr"), share("c").alias("frac_expressed"), "n_cells")


def all_stats(parts: dict[str, tuple[Dataset, str]]) -> DataFrame:
    """AG6: all datasets', merged where several hold the same group; narrow types at the end."""
    rows = reduce(DataFrame.unionByName, [class_stats(d, major) for d, major in parts.values()])
    return as_written(merge_stats(rows))


def as_written(stats: DataFrame) -> DataFrame:
    """SK2: columns and types of the statistics' file."""
    return stats.select("donor_id", "granularity", "cell_type", "gene_symbol", F.col("mean_expr").cast("float"), F.col("frac_expressed").cast("float"), F.col("n_cells").cast("int"))


def run(
    spark: SparkSession, input_dir: str, output_dir: str, clinical_csv: str, majors: dict[str, str], individuals_csv: str | None = None,
    resume: bool = False, keep_intermediate: bool = True, single_file: bool = False,
) -> dict:
    """Statistics as Parquet by granularity, donors as TSV, README and summary; returns the summary's numbers.

    ``resume`` keeps written statistics. ``single_file`` writes them once more as one file;
    without ``keep_intermediate`` that file alone stays.
    """
    clinical = clinical_columns(read_table(spark, clinical_csv))
    stats_path = f"{output_dir}/stats"
    if not resume:
        parts = {p: (read_dataset(spark, p), m) for p, m in resolve_inputs(spark, input_dir, majors).items()}
        for data, _ in parts.values():
            warn_of_fractions(data.expr.filter(F.col("layer") == MAIN))
        genes = reduce(DataFrame.unionByName, [d.var.select("gene", F.lit(p).alias("part")) for p, (d, _) in parts.items()])
        warn_of_gene_counts(genes, "part")
        all_stats(parts).write.partitionBy("granularity").option("compression", "zstd").parquet(stats_path)
    stats = spark.read.parquet(stats_path).select(*STATS)
    counts = counts_by_class(counts_from_stats(stats))
    individuals = read_table(spark, individuals_csv, text=()) if individuals_csv else None
    donors = donor_metadata(counts, clinical, individuals)
    write_tsv(counts_last(donors, "donor_id", ["total_cells", *(f"n_cells_{m}" for m in MAJORS)]), f"{output_dir}/donors")
    numbers = summary(stats)
    write_summary(spark, numbers, output_dir, "Statistics per donor and cell type", {"inputs": input_dir, "classes": ", ".join(f"{k}={v}" for k, v in majors.items())})
    if single_file:
        write_single(stats, f"{output_dir}/stats_single")
        if not keep_intermediate:
            remove(spark, stats_path)
    return numbers
