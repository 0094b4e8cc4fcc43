"""PR7, SK2: categories. ``obs`` holds the values as strings; a code table beside it holds each column's levels and their order.

levels: column string, code bigint (from 0, in the order of the levels), level string, ordered boolean

Levels stay when the cells that have them go, so codes mean the same before and after a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..model import Dataset
from .columns import as_category
from .numbering import numbered


def _coded(rows: DataFrame, *order: Column) -> DataFrame:
    """A code table of (column, level, ordered, ...), counted in each column in ``order``; the levels are dealt out by ranges, of however many there are."""
    places = numbered(rows, [F.asc("column"), *order, F.asc("level")], "_place")
    first = places.groupBy("column").agg(F.min("_place").alias("_first"))
    return places.join(first, "column").select("column", (F.col("_place") - F.col("_first")).alias("code"), "level", "ordered")


def category_columns(data: Dataset) -> list[str]:
    """Columns that have a code table."""
    return [] if data.levels is None else sorted(r["column"] for r in data.levels.select("column").distinct().collect())


def categorise(data: Dataset, columns: Sequence[str]) -> Dataset:
    """Listed columns of ``obs`` as categories: numbers in their order, all else by its text; NULL is no level.

    Columns that are missing, or categories already, are passed over.
    """
    known = category_columns(data)
    new = [c for c in dict.fromkeys(columns) if c in data.obs.columns and c not in known]
    if not new:
        return data
    kinds = {f.name: f.dataType for f in data.obs.schema}
    number = lambda c: F.col(f"`{c}`").cast("double") if isinstance(kinds[c], NumericType) else F.lit(None).cast("double")
    cells = data.obs.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level"), number(c).alias("_number")) for c in new))))
    found = cells.filter("level IS NOT NULL").groupBy("column", "level").agg(F.min("_number").alias("_number"), F.lit(False).alias("ordered"))
    levels = _coded(found, F.asc_nulls_first("_number"))
    return data.with_(obs=as_category(data.obs, new), levels=levels if data.levels is None else data.levels.unionByName(levels))


def set_order(data: Dataset, column: str, levels: Sequence[str], ordered: bool = True) -> Dataset:
    """``levels`` come first, in this order and also where no cell has them; others follow in the order they had."""
    if column not in category_columns(data):
        raise ValueError(f"{column} is not a category")
    if len(set(levels)) < len(levels):
        raise ValueError("a level stands there twice")
    named = data.levels.sparkSession.createDataFrame(list(enumerate(levels)), "_named long, level string")
    own = data.levels.filter(F.col("column") == column).select("level", "code").join(named, "level", "full")
    rows = own.select(F.lit(column).alias("column"), "level", F.lit(ordered).alias("ordered"), "_named", "code")
    return data.with_(levels=data.levels.filter(F.col("column") != column).unionByName(_coded(rows, F.asc_nulls_last("_named"), F.asc("code"))))


def drop_unused(data: Dataset) -> Dataset:
    """Levels that no cell has go, and the others are coded anew in the same order."""
    columns = [c for c in category_columns(data) if c in data.obs.columns]
    if not columns:
        return data
    used = data.obs.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("level")) for c in columns)))).distinct()
    return data.with_(levels=_coded(data.levels.join(used, ["column", "level"], "left_semi"), F.asc("code")))


def with_codes(data: Dataset, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """``obs`` with the codes of some categories beside them; NULL, and a value that is no level, have none."""
    out = data.obs
    for c in columns:
        level, code = f"_level_of_{c}", c + suffix
        codes = data.levels.filter(F.col("column") == c).select(F.col("level").alias(level), F.col("code").alias(code))
        out = out.join(codes, out[f"`{c}`"] == codes[f"`{level}`"], "left").drop(level)
    return out


def united(parts: Sequence[Dataset]) -> DataFrame | None:
    """Code table of concatenated parts: levels of the first part in their order, then what each later one adds.

    A column is a category if it is one in every part that has it, and ordered if all of these have
    the same levels in the same order and call them ordered.
    """
    tables = [p.levels.withColumn("_part", F.lit(i)) for i, p in enumerate(parts) if p.levels is not None]
    if not tables:
        return None
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    having = {c: sum(c in p.obs.columns for p in parts) for c in dict.fromkeys(c for p in parts for c in p.obs.columns)}
    needed = F.try_element_at(F.create_map(*(F.lit(x) for kv in having.items() for x in kv)), F.col("column"))
    columns = rows.groupBy("column").agg(F.count_distinct("_part").alias("_parts")).filter(F.col("_parts") == needed)
    each = rows.groupBy("column", "level").agg(
        F.min(F.struct("_part", "code")).alias("_at"), F.count(F.lit(1)).alias("_n"),
        ((F.min("code") == F.max("code")) & F.bool_and("ordered")).alias("_alike"),
    ).join(columns, "column")
    same = each.groupBy("column").agg(F.bool_and(F.col("_alike") & (F.col("_n") == F.col("_parts"))).alias("ordered"))
    return _coded(each.join(same, "column").select("column", "level", "ordered", "_at"), F.asc("_at"))
