"""SK3, SK5, SK8, SK9: what a run leaves beside its tables."""

from __future__ import annotations

import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import write_list, write_tsv
from .store import put_text


log = logging.getLogger("cytospark")


def write_scores(scores: DataFrame, folder: str) -> None:
    """SK5: scores of all genes, best first, as TSV; names of the chosen ones as text."""
    rank = [F.col(c).asc_nulls_last() if c == "highly_variable_rank" else F.col(c).desc_nulls_last() for c in ("highly_variable_rank", "variances_norm", "dispersions_norm") if c in scores.columns]
    write_tsv(scores.orderBy(*rank, "gene"), f"{folder}/scores")
    write_list(scores.filter("highly_variable"), f"{folder}/genes")


def write_single(df: DataFrame, path: str) -> None:
    """SK3: one Parquet file with zstd in a folder, for readers that want one; the columns' types are fixed by ``df``."""
    df.coalesce(1).write.option("compression", "zstd").parquet(path)


def summary(stats: DataFrame) -> dict:
    """SK9: numbers of a table of statistics, from one aggregate."""
    row = stats.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("donor_id").alias("donors"), F.count_distinct("cell_type").alias("cell_types"), F.count_distinct("gene_symbol").alias("genes"),
        F.min("mean_expr").alias("least_mean"), F.max("mean_expr").alias("greatest_mean"), F.min("frac_expressed").alias("least_share"), F.max("frac_expressed").alias("greatest_share"),
        F.count_if(F.col("frac_expressed").between(0, 1) & (F.col("mean_expr") >= 0)).alias("sound_rows"),
    ).first()
    return row.asDict()


def write_summary(spark: SparkSession, numbers: dict, folder: str, title: str, settings: dict | None = None) -> None:
    """SK8, SK9: README.md and summary.json in ``folder``, any store that Spark writes; the numbers go to the log too."""
    log.info("summary: %s", json.dumps(numbers))
    lines = [f"# {title}", "", *(f"- {k.replace('_', ' ')}: {v}" for k, v in numbers.items())]
    if settings:
        lines += ["", "Settings:", "", *(f"- {k}: {v}" for k, v in settings.items())]
    for name, text in (("README.md", "\n".join(lines)), ("summary.json", json.dumps(numbers, indent=2))):
        put_text(spark, f"{folder}/{name}", text + "\n")


def log_to(folder: str, level: int = logging.INFO) -> logging.Handler:
    """A run's log file beside its results."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(Path(folder) / "run.log")
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    log.setLevel(level)
    log.addHandler(handler)
    return handler
