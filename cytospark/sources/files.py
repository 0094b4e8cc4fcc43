"""SC1-SC13: scans of matrices, tables and gene lists, and what must hold of a path."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import list_label, list_top_n
from ..model import Dataset
from ..operators.combine import top_genes
from .clustered import read_clustered, read_layout
from .store import exists
from .versions import current


def read_dataset(spark: SparkSession, path: str) -> Dataset:
    """SC1: a dataset that ``Dataset.write`` or ``write_clustered`` wrote, or its current version; any store that Spark reads."""
    path = current(spark, path)
    if layout := read_layout(spark, path):
        return read_clustered(spark, path, layout)
    further = (spark.read.parquet(f"{path}/{t}") if exists(spark, f"{path}/{t}") else None for t in ("edges", "levels"))
    return Dataset(*(spark.read.parquet(f"{path}/{t}") for t in ("expr", "obs", "var")), *further)


def var_names(spark: SparkSession, path: str) -> DataFrame:
    """SC2, SC7: gene names alone; one column of one table is read."""
    return spark.read.parquet(f"{current(spark, path)}/var").select("gene").distinct()


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """SC9, SC10: some columns of a Parquet table; ``toArrow()`` of a small result gives it as an Arrow table."""
    return spark.read.parquet(path).select(*(F.col(f"`{c}`") for c in columns))


def read_table(spark: SparkSession, path: str, sep: str = ",", text: Sequence[str] = ("projid",)) -> DataFrame:
    """SC3-SC5: CSV or TSV with a header, types inferred but for ``text`` columns."""
    df = spark.read.csv(path, header=True, inferSchema=True, sep=sep)
    fixed = ", ".join(f"`{f.name}` {'string' if f.name in text else f.dataType.simpleString()}" for f in df.schema)
    return spark.read.csv(path, header=True, schema=fixed, sep=sep)


def read_gene_list(spark: SparkSession, path: str, comments: bool = False) -> DataFrame:
    """SC6, SC8: one name a line, trimmed, blanks and repeats dropped, ``#`` lines too if asked."""
    lines = spark.read.text(path).select(F.trim("value").alias("gene")).filter("gene <> ''")
    return (lines.filter(~F.col("gene").startswith("#")) if comments else lines).distinct()


def read_top_genes(spark: SparkSession, names_path: str, scores_path: str) -> DataFrame:
    """SC8: the top N of a scores file; N stands in the name of the list."""
    n = spark.range(1).select(list_top_n(F.lit(os.path.basename(names_path))).alias("n")).first()["n"]
    if n is None:
        return read_gene_list(spark, names_path, comments=True)
    scores = read_table(spark, scores_path, sep="\t")
    # The first column holds the names, whatever its heading.
    return top_genes(scores.withColumnRenamed(scores.columns[0], "gene"), n).select("gene")


def read_compared_list(spark: SparkSession, path: str) -> DataFrame:
    """SC8: a list as it is compared: the names of a selection are cut to the top N of the scores that lie beside them, any other list is whole."""
    scores = path.removesuffix("_hvg_names.txt") + "_hvg_scores.tsv"
    return read_top_genes(spark, path, scores) if path.endswith("_hvg_names.txt") and exists(spark, scores) else read_gene_list(spark, path, comments=True)


def label_of(spark: SparkSession, path: str) -> str:
    """PR19."""
    return spark.range(1).select(list_label(F.lit(path)).alias("x")).first()["x"]


def check_path(spark: SparkSession, path: str, extensions: Sequence[str] = ()) -> None:
    """SC13: a path that exists with one of the extensions."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if extensions and os.path.splitext(path.rstrip("/"))[1] not in extensions:
        raise ValueError(f"{path}: expected one of {', '.join(extensions)}")


def resolve_inputs(spark: SparkSession, folder: str, majors: dict[str, str]) -> dict[str, str]:
    """SC12: {path: class} of the datasets that are there, under their name or its lower case."""
    found = {}
    for stem, major in majors.items():
        path = next((p for p in (f"{folder}/{stem}", f"{folder}/{stem.lower()}") if exists(spark, p)), None)
        if path:
            found[path] = major
    if not found:
        raise FileNotFoundError(f"no dataset of {', '.join(majors)} in {folder}")
    return found


def write_list(genes: DataFrame, path: str) -> None:
    """SK5-SK7: sorted names, one a line."""
    genes.select("gene").distinct().sort("gene").write.text(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """SK4, SK5."""
    df.write.csv(path, sep="\t", header=True)
