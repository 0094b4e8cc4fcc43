"""Dense numbers for rows in a total order, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..scratch import materialise


def numbered(df: DataFrame, order: Sequence[Column], name: str = "number", start: int = 0) -> DataFrame:
    """``df`` with ``name`` counting from ``start`` in ``order``; rows that tie are numbered in any order.

    Rows are dealt out by ranges of ``order``, sorted where they are and written once; each
    range then starts where the ones before it end. Only one count a range reaches the driver.
    An order whose every value is common should end in a column that tells rows apart.
    """
    held = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = materialise(held.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = {r["_range"]: r["count"] for r in held.groupBy("_range").count().collect()}
    first, at = [], start
    for i in range(max(sizes, default=0) + 1):
        first.append(at)
        at += sizes.get(i, 0)
    offset = F.element_at(F.expr(f"array({', '.join(f'{x}L' for x in first)})"), F.col("_range") + 1)
    out = held.withColumn(name, offset + F.col("_at")).drop("_range", "_at")
    out._scratch = held._scratch
    return out
