"""Statistics kept up to date as files of partial statistics arrive (AG6 by micro-batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import merge_stats
from ..plans.aggregate import STATS

SCHEMA = "donor_id string, granularity string, cell_type string, gene_symbol string, mean_expr double, frac_expressed double, n_cells long"


def follow(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch, merged within itself, under its own id, until no file is new.

    A batch that is run again after a failure overwrites its own folder, so nothing counts twice.
    """

    def take(batch: DataFrame, number: int) -> None:
        merge_stats(batch).select(*STATS).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(SCHEMA).parquet(source)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The merged statistics of all batches."""
    return merge_stats(spark.read.parquet(target))
