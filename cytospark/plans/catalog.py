"""Queries of the operators on the bundled tables, each with its SQL where SQL can state it.

The tables stand in for a count matrix: a customer is a cell, a part is a gene, the
quantity a customer ordered of a part is the value, the nation is the donor and the
market segment the subtype. Two segments share one class, so merging by class is real.
Floats are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.labels import BRAAK, CERAD, THAL, diagnosis, list_label, list_top_n, ordinal
from ..model import AGGREGATE_TARGET, FEATURE_TARGET, MAIN, TOP_GENES, Dataset, looked_up, spread, tasks_for
from ..operators import aggregates as ag
from ..operators import columns as co
from ..operators import combine as cb
from ..operators import filters as fi
from ..operators import joins as jo
from ..operators import report as rp
from ..operators.cells import take_cells, without_prefix
from ..operators.components import components
from ..operators.categories import categorise, set_order, with_codes
from ..operators.embedding import fuzzy_edges, neighbours
from ..operators.selection import by_dispersion, by_standardised_variance
from ..scratch import materialise, scratch_path
from ..sources.clustered import GENE_STATS, stored_moments, write_clustered
from ..sources.files import read_dataset
from .aggregate import as_written, class_stats
from .feature import features

SEGMENTS = {"AUTOMOBILE": "Ex", "BUILDING": "In", "FURNITURE": "Ast", "HOUSEHOLD": "Mic", "MACHINERY": "Ex"}
PRIORITY = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}
LEAST = 25
MAJOR_SQL = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Ex' WHEN 'BUILDING' THEN 'In' WHEN 'FURNITURE' THEN 'Ast' WHEN 'HOUSEHOLD' THEN 'Mic' WHEN 'MACHINERY' THEN 'Ex' END"
PRIORITY_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3 WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 END"

CTE = f"""WITH expr AS (SELECT CAST(o_custkey AS VARCHAR) AS cell_id, CAST(l_partkey AS VARCHAR) AS gene, SUM(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
obs AS (SELECT CAST(c_custkey AS VARCHAR) AS cell_id, c_custkey AS cell_ord, c_nationkey AS donor, c_mktsegment AS subtype, {MAJOR_SQL} AS major FROM customer),
var AS (SELECT CAST(p_partkey AS VARCHAR) AS gene, p_partkey AS gene_ord, p_brand AS brand FROM part),
n AS (SELECT count(*) AS n_cells FROM obs),
size AS (SELECT cell_id, SUM(value) AS library_size FROM expr GROUP BY 1),
lognorm AS (SELECT cell_id, gene, value, ln(1 + value * {AGGREGATE_TARGET} / library_size) AS norm FROM expr JOIN size USING (cell_id)),
"""
CTE_ONLY = CTE.rstrip().rstrip(",") + "\n"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dataset(spark: SparkSession, d: str) -> Dataset:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    # Dealt by cell, values are added up, normalised and joined with cells where they are.
    tasks = tasks_for(spark, lines.count())
    each = spread(lines, tasks, "l_orderkey").join(looked_up(orders, tasks), F.col("l_orderkey") == F.col("o_orderkey"))
    each = each.select(F.col("o_custkey").cast("string").alias("cell_id"), F.col("l_partkey").cast("string").alias("gene"), "l_quantity")
    expr = spread(each, tasks, "cell_id").groupBy("cell_id", "gene").agg(F.sum("l_quantity").alias("value")).withColumn("layer", F.lit(MAIN))
    segments = F.create_map(*(F.lit(x) for kv in SEGMENTS.items() for x in kv))
    obs = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("cell_id"), F.col("c_custkey").alias("cell_ord"), F.col("c_nationkey").alias("donor"),
        F.col("c_mktsegment").alias("subtype"), F.try_element_at(segments, F.col("c_mktsegment")).alias("major"),
    )
    var = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("gene"), F.col("p_partkey").alias("gene_ord"), F.col("p_brand").alias("brand"))
    return Dataset(expr, obs, var, tasks=tasks)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in names})


def lognorm(data: Dataset) -> DataFrame:
    return ag.normalise(data.expr, AGGREGATE_TARGET)


# --- group statistics -------------------------------------------------------------

STATS_SQL = """sizes AS (SELECT donor, {k} AS cell_type, count(*) AS n_cells FROM obs GROUP BY 1, 2),
sums AS (SELECT donor, {k} AS cell_type, gene, SUM(norm) AS s, count(*) FILTER (value > 0) AS c FROM lognorm JOIN obs USING (cell_id) GROUP BY 1, 2, 3),
stats AS (SELECT g.donor, g.cell_type, v.gene, COALESCE(s, 0) / n_cells AS mean_expr, COALESCE(c, 0) / n_cells AS frac_expressed, n_cells
  FROM sizes g CROSS JOIN var v LEFT JOIN sums t ON t.donor = g.donor AND t.cell_type = g.cell_type AND t.gene = v.gene)
"""


@query(CTE + STATS_SQL.format(k="subtype") + "SELECT donor, cell_type AS subtype, gene, round(mean_expr, 6) AS mean_expr, round(frac_expressed, 6) AS frac_expressed, n_cells FROM stats")
def group_stats_subtype(spark, d):
    """NK1, NK2, AG2, AG3, PR20: the flagship."""
    x = dataset(spark, d)
    return rounded(ag.group_stats(lognorm(x), x.obs, x.var, ["donor", "subtype"]), "mean_expr", "frac_expressed")


@query(CTE + """t AS (SELECT CAST(donor AS VARCHAR) AS donor_id, CASE WHEN grouping(subtype) = 1 THEN 'major' ELSE 'subtype' END AS granularity,
 CASE WHEN grouping(subtype) = 1 THEN major ELSE subtype END AS cell_type, gene, SUM(norm) AS s, count(*) FILTER (value > 0) AS n_expressing
 FROM lognorm JOIN obs USING (cell_id) GROUP BY GROUPING SETS ((donor, subtype, gene), (donor, major, gene)))
SELECT donor_id, granularity, cell_type, gene, round(s, 6) AS sum_norm, n_expressing FROM t""")
def group_stats_grouping_sets(spark, d):
    """AG4, AG5."""
    x = dataset(spark, d)
    return rounded(ag.two_granularities(lognorm(x), x.obs, "donor", "subtype", "major", x.tasks), "sum_norm")


@query(CTE + STATS_SQL.format(k="subtype") + """, m AS (SELECT donor, CASE cell_type WHEN 'AUTOMOBILE' THEN 'Ex' WHEN 'BUILDING' THEN 'In' WHEN 'FURNITURE' THEN 'Ast' WHEN 'HOUSEHOLD' THEN 'Mic' ELSE 'Ex' END AS major, gene, mean_expr, frac_expressed, n_cells FROM stats)
SELECT donor, major, gene, round(SUM(n_cells * mean_expr) / SUM(n_cells), 6) AS mean_expr, round(SUM(n_cells * frac_expressed) / SUM(n_cells), 6) AS frac_expressed, CAST(SUM(n_cells) AS BIGINT) AS n_cells FROM m GROUP BY 1, 2, 3""")
def weighted_merge(spark, d):
    """AG6: one file a segment, merged by class."""
    x = dataset(spark, d)
    parts = ag.group_stats(lognorm(x), x.obs, x.var, ["donor", "subtype"])
    segments = F.create_map(*(F.lit(v) for kv in SEGMENTS.items() for v in kv))
    out = ag.merge_stats(parts.withColumn("major", F.try_element_at(segments, F.col("subtype"))), ["donor", "major", "gene"])
    return rounded(out, "mean_expr", "frac_expressed")


PIVOT = ", ".join(f"count(*) FILTER (major = '{m}') AS n_cells_{m}" for m in ag.MAJORS)


@query(CTE + f"t AS (SELECT CAST(donor AS VARCHAR) AS donor_id, {PIVOT} FROM obs GROUP BY 1) SELECT *, n_cells_Ex + n_cells_In + n_cells_Ast + n_cells_Mic + n_cells_Oli + n_cells_Opc AS total_cells FROM t")
def donor_counts_pivot(spark, d):
    """AG7, JO3."""
    return ag.donor_counts(dataset(spark, d).obs, "donor", "major")


@query(CTE + "x AS (SELECT 1) SELECT CAST(donor AS VARCHAR) AS donor_id, major AS cell_type, count(*) AS n_cells FROM obs GROUP BY 1, 2")
def counts_from_stats(spark, d):
    """AG9: counts back from the statistics."""
    x = dataset(spark, d)
    s = ag.group_stats(lognorm(x), x.obs, x.var, ["donor", "major"])
    return ag.counts_from_stats(s.select(F.col("donor").cast("string").alias("donor_id"), F.lit("major").alias("granularity"), F.col("major").alias("cell_type"), "n_cells"))


@query(CTE + "x AS (SELECT 1) SELECT major, count(DISTINCT gene) AS n_genes FROM expr JOIN obs USING (cell_id) GROUP BY 1")
def gene_count_check(spark, d):
    """AG10: genes of each file."""
    x = dataset(spark, d)
    return x.expr.join(x.obs.select("cell_id", "major"), "cell_id").groupBy("major").agg(F.count_distinct("gene").alias("n_genes"))


@query(CTE_ONLY + "SELECT cell_id, library_size FROM size")
def library_size(spark, d):
    """AG1."""
    return ag.library_sizes(dataset(spark, d).expr)


@query(CTE_ONLY + f"SELECT cell_id, gene, round(value * {FEATURE_TARGET} / library_size, 6) AS norm FROM expr JOIN size USING (cell_id)")
def normalize_cpm(spark, d):
    """NK1, NK10."""
    return rounded(ag.normalise(dataset(spark, d).expr, FEATURE_TARGET, log=False), "norm").select("cell_id", "gene", "norm")


@query(CTE_ONLY + "SELECT cell_id, gene, round(norm, 6) AS norm FROM lognorm")
def lognorm_values(spark, d):
    """NK2."""
    return rounded(lognorm(dataset(spark, d)), "norm").select("cell_id", "gene", "norm")


@query(CTE + "s AS (SELECT gene, SUM(value) AS s1, SUM(value * value) AS s2 FROM expr GROUP BY 1) SELECT gene, round(s1 / n_cells, 6) AS mean, round((s2 - n_cells * (s1 / n_cells) * (s1 / n_cells)) / (n_cells - 1), 6) AS variance FROM s, n")
def gene_moments(spark, d):
    """AG19."""
    x = dataset(spark, d)
    return rounded(ag.gene_moments(x.expr, x.obs.count()), "mean", "variance")


def stored_by_cell(spark: SparkSession, d: str) -> str:
    """A dataset of the tables, stored by cell in the shared folder."""
    path = scratch_path(spark, "by_cell")
    write_clustered(dataset(spark, d), path)
    return path


@query(CTE + "spread AS (SELECT donor, subtype, cell_id, CAST(c AS BIGINT) AS n_genes, round(m, 6) AS mean_norm FROM obs JOIN (SELECT cell_id, count(*) AS c, avg(norm) AS m FROM lognorm GROUP BY 1) USING (cell_id)) SELECT * FROM spread")
def stored_normalised(spark, d):
    """SK1, NK1, NK2: cells of a dataset stored by cell, normalised, summed up and joined without an exchange of values."""
    x = read_dataset(spark, stored_by_cell(spark, d))
    by_cell = lognorm(x).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_genes"), r6(F.avg("norm")).alias("mean_norm"))
    return x.obs.select("donor", "subtype", "cell_id").join(by_cell, "cell_id").select("donor", "subtype", "cell_id", "n_genes", "mean_norm")


@query(ORACLE_SQL["gene_moments"])
def stored_gene_moments(spark, d):
    """SK1, AG19: from the statistics that lie beside a dataset stored by cell."""
    path = stored_by_cell(spark, d)
    n_cells = read_dataset(spark, path).obs.count()
    return rounded(stored_moments(spark.read.parquet(f"{path}/{GENE_STATS}"), n_cells, MAIN), "mean", "variance")


# --- filters ----------------------------------------------------------------------

KEPT_CELLS = f"kept AS (SELECT cell_id, count(*) FILTER (value > 0) AS n_genes FROM expr GROUP BY 1 HAVING count(*) FILTER (value > 0) >= {LEAST})"


@query(CTE + KEPT_CELLS + "SELECT cell_id, n_genes FROM kept")
def filter_cells(spark, d):
    """FI1."""
    return fi.cells_with_genes(dataset(spark, d).expr, LEAST)


@query(CTE + KEPT_CELLS + f"SELECT gene, count(*) FILTER (value > 0) AS n_cells FROM expr WHERE cell_id IN (SELECT cell_id FROM kept) GROUP BY 1 HAVING count(*) FILTER (value > 0) >= {LEAST}")
def filter_genes(spark, d):
    """FI2, after FI1."""
    return fi.genes_in_cells(fi.keep_cells(dataset(spark, d), LEAST).expr, LEAST)


def _brand(spark, d, *brands: int) -> DataFrame:
    names = [f"Brand#{b}" for b in brands]
    return table(spark, d, "part").filter(F.col("p_brand").isin(names)).select(F.col("p_partkey").cast("string").alias("gene"))


def _brand_sql(*brands: int) -> str:
    return "SELECT CAST(p_partkey AS VARCHAR) AS gene FROM part WHERE p_brand IN (" + ", ".join(f"'Brand#{b}'" for b in brands) + ")"


@query(CTE_ONLY + f"SELECT cell_id, gene, value FROM expr WHERE gene IN ({_brand_sql(12, 13)})")
def import_genes(spark, d):
    """FI3."""
    return fi.keep_genes(dataset(spark, d), _brand(spark, d, 12, 13)).expr.select("cell_id", "gene", "value")


@query(CTE_ONLY + "SELECT cell_id, donor FROM (SELECT *, count(*) OVER (PARTITION BY donor) AS k FROM obs WHERE donor IS NOT NULL) WHERE k > 1")
def skip_singletons(spark, d):
    """FI6."""
    return fi.without_single_cells(dataset(spark, d).obs, "donor").select("cell_id", "donor")


@query("SELECT CAST(l_partkey AS VARCHAR) AS gene FROM lineitem UNION SELECT '' WHERE FALSE")
def scan_var_names(spark, d):
    """SC2, SC7, AG8: one column is read."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("gene")).distinct()


@query(f"SELECT gene FROM (VALUES ('absent')) t(gene) UNION ALL SELECT p.gene FROM ({_brand_sql(12)}) p WHERE p.gene NOT IN (SELECT CAST(l_partkey AS VARCHAR) FROM lineitem)")
def missing_genes(spark, d):
    """JO8."""
    wanted = _brand(spark, d, 12).union(spark.range(1).select(F.lit("absent").alias("gene")))
    return jo.missing_from(wanted, scan_var_names(spark, d))


@query(f"SELECT * FROM ({_brand_sql(12, 13)}) INTERSECT SELECT * FROM ({_brand_sql(13, 14)})")
def gene_intersect(spark, d):
    """SE7."""
    return _brand(spark, d, 12, 13).intersect(_brand(spark, d, 13, 14))


@query(f"SELECT * FROM ({_brand_sql(12, 13)}) UNION SELECT * FROM ({_brand_sql(13, 14)})")
def gene_union(spark, d):
    """AG20, SE8."""
    return _brand(spark, d, 12, 13).union(_brand(spark, d, 13, 14)).distinct()


@query(f"SELECT * FROM ({_brand_sql(12, 13)}) EXCEPT SELECT * FROM ({_brand_sql(13, 14)})")
def gene_except(spark, d):
    """SE9."""
    return jo.missing_from(_brand(spark, d, 12, 13), _brand(spark, d, 13, 14))


# --- columns ----------------------------------------------------------------------


@query("""SELECT c_custkey AS cell_id, c_nationkey AS "Donor ID", c_mktsegment AS "Class" FROM customer""")
def map_columns_a(spark, d):
    """PR1: of four names two are there."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("individualID"), F.col("c_mktsegment").alias("class"))
    return co.cohort_columns(c)


@query("""SELECT c_custkey AS cell_id, c_nationkey AS "Donor ID", c_mktsegment AS "Subtype", 'Glia' AS "Class", 'Immune' AS "Celltype" FROM customer""")
def map_columns_b(spark, d):
    """PR2, PR6."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("projid"), F.col("c_mktsegment").alias("cell_type_high_resolution"))
    return co.harmonise(c, "per_class", "Glia", "Immune")


@query("""SELECT c_custkey AS cell_id, c_mktsegment AS "Celltype", c_name AS "Subtype" FROM customer""")
def map_columns_c(spark, d):
    """PR3."""
    return co.atlas_columns(table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_mktsegment").alias("Subclass"), F.col("c_name").alias("Supertype")))


@query(f"SELECT o_orderkey, {PRIORITY_SQL} AS score FROM orders")
def map_ordinal(spark, d):
    """PR4: a text without a score gives NULL."""
    return table(spark, d, "orders").select("o_orderkey", ordinal(F.col("o_orderpriority"), PRIORITY).alias("score"))


BRAAK_SQL, CERAD_SQL = "o_orderkey % 7", f"({PRIORITY_SQL})"
CASE_SQL = f"CASE WHEN o_orderstatus = 'F' AND {BRAAK_SQL} >= 4 AND {CERAD_SQL} <= 2 THEN 'AD' WHEN o_orderstatus <> 'F' AND {BRAAK_SQL} <= 3 AND {CERAD_SQL} >= 3 THEN 'Healthy' ELSE 'Intermediate' END"


def _cases(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "Dementia").otherwise(F.col("o_orderstatus"))
    return o.select("o_orderkey", "o_custkey", diagnosis(status, F.col("o_orderkey") % 7, ordinal(F.col("o_orderpriority"), PRIORITY)).alias("label"))


@query(f"SELECT o_orderkey, {CASE_SQL} AS label FROM orders")
def case_label(spark, d):
    """PR5, N1, N2."""
    return _cases(spark, d).select("o_orderkey", "label")


@query(f"SELECT {CASE_SQL} AS label, count(DISTINCT o_custkey) AS donors FROM orders WHERE {CASE_SQL} <> 'Intermediate' GROUP BY 1")
def extreme_donors(spark, d):
    """AG12, FI9."""
    return _cases(spark, d).filter("label <> 'Intermediate'").groupBy("label").agg(F.count_distinct("o_custkey").alias("donors"))


@query("SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer")
def cast_category(spark, d):
    """PR7; a column that is missing is passed over."""
    return co.as_category(table(spark, d, "customer").select("c_custkey", "c_nationkey"), ["c_nationkey", "absent"])


@query("""WITH d AS (SELECT 'donor' AS "column", c_nationkey AS k, CAST(c_nationkey AS VARCHAR) AS level, count(*) AS cells FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 2),
s AS (SELECT 'subtype' AS "column", c_mktsegment AS level, count(*) AS cells FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 2)
SELECT "column", row_number() OVER (ORDER BY k < 10, k) - 1 AS code, level, false AS ordered, cells FROM d
UNION ALL SELECT "column", row_number() OVER (ORDER BY level DESC) - 1, level, true, cells FROM s""")
def category_codes(spark, d):
    """PR7, SK2, SE1: codes and order of the categories of two concatenated parts, and the cells that have them."""
    x = dataset(spark, d)
    x = set_order(categorise(x, ["subtype", "absent"]), "subtype", sorted(SEGMENTS, reverse=True))
    high = F.coalesce(F.col("donor") >= 10, F.lit(False))
    parts = {"high": high, "low": ~high}
    both = cb.concat({name: categorise(x.with_(obs=x.obs.filter(rule)), ["donor"]) for name, rule in parts.items()})
    codes = with_codes(both, ["donor", "subtype"])
    pairs = codes.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"{c}_code").alias("code")) for c in ("donor", "subtype")))))
    cells = pairs.groupBy("column", "code").agg(F.count(F.lit(1)).alias("cells"))
    return both.levels.join(cells, ["column", "code"]).select("column", "code", "level", "ordered", "cells")


@query(CTE_ONLY + "SELECT cell_id, gene, CAST(value AS INTEGER) AS value FROM expr")
def cast_counts(spark, d):
    """PR8."""
    return co.cast_counts(dataset(spark, d).expr).select("cell_id", "gene", "value")


@query(CTE_ONLY + "SELECT COALESCE(avg(CASE WHEN value = floor(value) THEN 1 ELSE 0 END), 1) > 0.99 AS counts FROM expr JOIN obs USING (cell_id) JOIN var USING (gene) WHERE cell_ord < 500 AND gene_ord < 200 AND value > 0")
def detect_counts(spark, d):
    """PR10; the sample of first cells and genes is the operator."""
    return spark.range(1).select(F.lit(co.looks_like_counts(dataset(spark, d))).alias("counts"))


@query("SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS cell_id, l_extendedprice AS value FROM lineitem")
def select_layer(spark, d):
    """PR12, PR13, PR9."""
    lines = table(spark, d, "lineitem").withColumn("cell_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    layers = lines.select("cell_id", F.explode(F.create_map(F.lit(MAIN), F.col("l_quantity"), F.lit("UMIs"), F.col("l_extendedprice"))).alias("layer", "value"))
    return co.select_layer(Dataset(layers, layers, layers), "UMIs").expr.select("cell_id", "value")


@query("SELECT n_nationkey, CAST(n_regionkey AS DOUBLE) AS region, n_name FROM nation")
def infer_numeric(spark, d):
    """PR15, N5."""
    return co.infer_numeric(table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("region"), "n_name"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS donor_id, n_regionkey AS "Braak", n_name AS "individualID" FROM nation""")
def clinical_project(spark, d):
    """PR17."""
    return co.clinical_columns(_clinical(spark, d))


def _clinical(spark, d) -> DataFrame:
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("projid"), F.col("n_regionkey").alias("braaksc"), F.col("n_name").alias("individualID"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(p_brand || '_hvg2k_k30', '_k30$', ''), '_k15$', '') AS label, 2000 AS top_n FROM part")
def short_label(spark, d):
    """PR19, SC8."""
    path = F.concat(F.lit("lists/"), F.col("p_brand"), F.lit("_hvg2k_k30_hvg_names.txt"))
    return table(spark, d, "part").select("p_partkey", list_label(path).alias("label"), list_top_n(path).alias("top_n"))


# --- joins ------------------------------------------------------------------------


@query("""SELECT c_custkey AS cell_id, c_nationkey AS projid, c_name AS name, n_name AS name_metadata, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def join_metadata(spark, d):
    """JO1, N3, N4: int key to text key, and a colliding column."""
    obs = table(spark, d, "customer").select(F.col("c_custkey").alias("cell_id"), F.col("c_nationkey").alias("projid"), F.col("c_name").alias("name"))
    regions = table(spark, d, "region")
    meta = table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").cast("string").alias("projid"), F.col("n_name").alias("name"), F.col("r_name").alias("region"))
    return jo.add_metadata(obs, meta)


@query("SELECT count(*) FILTER (n_name IS NULL) AS name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey > 0) ON c_nationkey = n_nationkey")
def join_miss_count(spark, d):
    """JO2."""
    obs = table(spark, d, "customer").select(F.col("c_nationkey").alias("projid"))
    meta = table(spark, d, "nation").filter("n_regionkey > 0").select(F.col("n_nationkey").alias("projid"), F.col("n_name").alias("name"))
    return jo.misses(jo.add_metadata(obs, meta), ["name"])


@query("""SELECT CAST(donor AS VARCHAR) AS donor_id, n, n_regionkey AS "Braak", n_name AS "individualID", min(r_name) AS subject FROM (SELECT c_nationkey AS donor, count(*) AS n FROM customer GROUP BY 1) LEFT JOIN nation ON donor = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def donor_metadata(spark, d):
    """JO4, JO5, PR18."""
    counts = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("string").alias("donor_id")).agg(F.count(F.lit(1)).alias("n"))
    people = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("individualID"), F.col("r_name").alias("subject"))
    return co.counts_last(jo.donor_metadata(counts, clinical_project(spark, d), people), "donor_id", ["n"])


def _sheet_sql(y: int) -> str:
    return f"(SELECT CAST(l_partkey AS VARCHAR) AS gene, SUM(l_quantity) AS total FROM lineitem WHERE l_linenumber = {y} GROUP BY 1)"


@query(f"""SELECT gene, a.total AS "Ex_total", b.total AS "In_total", c.total AS "Ast_total" FROM {_sheet_sql(5)} a FULL JOIN {_sheet_sql(6)} b USING (gene) FULL JOIN {_sheet_sql(7)} c USING (gene)""")
def deg_align(spark, d):
    """JO7."""
    lines = table(spark, d, "lineitem")
    sheet = lambda k: lines.filter(F.col("l_linenumber") == k).groupBy(F.col("l_partkey").cast("string").alias("gene")).agg(F.sum("l_quantity").alias("total"))
    return jo.align({"Ex": sheet(5), "In": sheet(6), "Ast": sheet(7)})


# --- concatenation and lists ------------------------------------------------------


def _halves(spark, d) -> dict[str, Dataset]:
    """Two files: cells by donor, the second without one brand of genes."""
    x = dataset(spark, d)
    first, second = x.obs.filter("donor < 12"), x.obs.filter("donor >= 12")
    part = lambda obs: x.with_(expr=x.expr.join(obs.select("cell_id"), "cell_id", "left_semi"), obs=obs)
    return {"a": part(first), "b": fi.keep_genes(part(second), x.var.filter("brand <> 'Brand#12'").select("gene"))}


HALVES_SQL = "cat AS (SELECT e.*, CASE WHEN donor < 12 THEN 'a' ELSE 'b' END AS source_file FROM expr e JOIN obs USING (cell_id) JOIN var USING (gene) WHERE donor < 12 OR brand <> 'Brand#12')"


@query(CTE + HALVES_SQL + "SELECT source_file, cell_id, gene, value FROM cat")
def concat_outer(spark, d):
    """SE1, JO6."""
    return cb.concat(_halves(spark, d)).expr.select("source_file", without_prefix(F.col("cell_id")).alias("cell_id"), "gene", "value")


@query(CTE + HALVES_SQL + "SELECT source_file, cell_id, gene, value FROM cat WHERE gene IN (SELECT gene FROM var WHERE brand <> 'Brand#12')")
def concat_inner(spark, d):
    """SE1, JO6."""
    return cb.concat(_halves(spark, d), join="inner").expr.select("source_file", without_prefix(F.col("cell_id")).alias("cell_id"), "gene", "value")


@query(CTE + """f AS (SELECT donor, min(cell_ord) AS first FROM obs GROUP BY 1), o AS (SELECT donor, CAST(row_number() OVER (ORDER BY first) - 1 AS VARCHAR) AS "all" FROM f)
SELECT cell_id || '-' || "all" AS cell_id, donor, "all" FROM obs JOIN o USING (donor)""")
def relabel_slices(spark, d):
    """SE3."""
    return cb.relabel_slices(dataset(spark, d), "donor").obs.select("cell_id", "donor", "all")


@query(CTE + """cat AS (SELECT 'a' AS source_file, cell_id, gene, value FROM expr UNION ALL SELECT 'b', cell_id, gene, value FROM expr JOIN var USING (gene) WHERE brand <> 'Brand#12'),
sizes AS (SELECT source_file, cell_id, SUM(value) AS t FROM cat GROUP BY 1, 2)
SELECT source_file, cell_id AS source_cell_id, gene, round(ln(1 + value * 10000 / t), 6) AS norm FROM cat JOIN sizes USING (source_file, cell_id)""")
def concat_clashing_cells(spark, d):
    """SE1, NK1: two files whose cells have the same ids are twice as many cells, each with a library size of its own."""
    x = dataset(spark, d)
    both = cb.concat({"a": x, "b": fi.keep_genes(x, x.var.filter("brand <> 'Brand#12'").select("gene"))})
    both = both.with_(expr=spread(both.expr, both.tasks, "cell_id"))
    cells = both.obs.select("cell_id", "source_cell_id")
    return rounded(lognorm(both).join(cells, "cell_id").select("source_file", "source_cell_id", "gene", "norm"), "norm")


GRAPH_SQL = """v AS (SELECT CAST(vec_id AS VARCHAR) AS cell_id, vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT a.label, a.vec_id AS src, b.vec_id AS dst, list_distance(a.x, b.x) AS d FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, CAST(dst AS VARCHAR)) AS rank FROM pairs),
f AS (SELECT label, min(vec_id) AS first FROM v GROUP BY 1), o AS (SELECT label, CAST(row_number() OVER (ORDER BY first) - 1 AS VARCHAR) AS slice FROM f),
vals AS (SELECT cell_id, len(list_filter(x, lambda c: c > 0)) AS n_values FROM v)
"""


def _graph(spark, d) -> Dataset:
    """Vectors as cells: what is above 0 as values, the label as donor, the nearest as graph."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("cell_id"), F.col("vec_id").alias("cell_ord"), F.col("label").alias("donor"), F.col("embedding").cast("array<double>").alias("pc"))
    expr = e.select("cell_id", F.posexplode("pc").alias("at", "value")).filter("value > 0").select(F.lit(MAIN).alias("layer"), "cell_id", F.col("at").cast("string").alias("gene"), "value")
    genes = expr.select("gene").distinct().withColumn("gene_ord", F.col("gene").cast("bigint"))
    return Dataset(expr, e.drop("pc"), genes, neighbours(e, 5).select("src", "dst", "rank"))


@query("WITH " + GRAPH_SQL + """, parts AS (SELECT * FROM (VALUES ('a', 0), ('b', 1)) AS t(source_file, part))
SELECT source_file, part || '-' || n.src AS src, part || '-' || n.dst AS dst, CAST(n.rank AS INTEGER) AS rank, CAST(n_values AS BIGINT) AS n_values
FROM parts CROSS JOIN near n JOIN vals ON cell_id = CAST(n.src AS VARCHAR) WHERE rank <= 5 AND (part = 0 OR n.label < 5)""")
def concat_graphs(spark, d):
    """SE1: graphs of two files with equal ids stay apart; both ends of every edge are cells of the combined file."""
    x = _graph(spark, d)
    both = cb.concat({"a": x, "b": take_cells(x, x.obs.filter("donor < 5"))})
    ends = both.edges.join(both.obs.select(F.col("cell_id").alias("src"), "source_file"), "src").join(both.obs.select(F.col("cell_id").alias("dst")), "dst")
    values = both.expr.groupBy(F.col("cell_id").alias("src")).agg(F.count(F.lit(1)).alias("n_values"))
    return ends.join(values, "src").select("source_file", "src", "dst", "rank", "n_values")


@query("WITH " + GRAPH_SQL + """SELECT src || '-' || slice AS src, dst || '-' || slice AS dst, slice AS "all", CAST(rank AS INTEGER) AS rank, CAST(n_values AS BIGINT) AS n_values
FROM near JOIN o USING (label) JOIN vals ON cell_id = CAST(src AS VARCHAR) WHERE rank <= 5""")
def slice_graph(spark, d):
    """SE3: after slices got their labels, the graph, the cells and the values still join."""
    x = cb.relabel_slices(_graph(spark, d), "donor")
    ends = x.edges.join(x.obs.select(F.col("cell_id").alias("src"), "all"), "src").join(x.obs.select(F.col("cell_id").alias("dst")), "dst")
    values = x.expr.groupBy(F.col("cell_id").alias("src")).agg(F.count(F.lit(1)).alias("n_values"))
    return ends.join(values, "src").select("src", "dst", "all", "rank", "n_values")


@query(CTE + f"""fit AS (SELECT cell_id FROM expr WHERE value > 0 GROUP BY 1 HAVING count(*) >= {LEAST}),
cut AS (SELECT e.cell_id, gene, value FROM expr e JOIN var USING (gene) WHERE brand < 'Brand#35' AND cell_id IN (SELECT cell_id FROM fit)),
t AS (SELECT cell_id, SUM(value) AS t FROM cut GROUP BY 1),
sums AS (SELECT cell_id, count(*) AS n_genes, SUM(ln(1 + value * {FEATURE_TARGET} / t)) AS s FROM cut JOIN t USING (cell_id) GROUP BY 1),
alive AS (SELECT * FROM obs WHERE cell_id IN (SELECT cell_id FROM fit) AND donor IN (SELECT donor FROM obs WHERE cell_id IN (SELECT cell_id FROM fit) GROUP BY 1 HAVING count(*) > 1)),
f AS (SELECT donor, min(cell_ord) AS first FROM alive GROUP BY 1), o AS (SELECT donor, CAST(row_number() OVER (ORDER BY first) - 1 AS VARCHAR) AS slice FROM f)
SELECT cell_id || '-' || slice AS cell_id, slice AS "all", COALESCE(n_genes, 0) AS n_genes, round(COALESCE(s, 0), 6) AS sum_norm, true AS in_graph, true AS has_components
FROM alive JOIN o USING (donor) LEFT JOIN sums USING (cell_id)""")
def feature_cells(spark, d):
    """Entry A with a list of genes: each cell it gives, with its values, whether it is at both ends of the graph, and its components."""
    x = dataset(spark, d)
    x = x.with_(obs=x.obs.withColumn("projid", F.col("donor").cast("string")))
    out = features(x, min_genes=LEAST, genes=x.var.filter("brand < 'Brand#35'").select("gene"), n_components=5, k=6)
    sums = out.data.expr.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_genes"), F.sum("norm").alias("sum_norm"))
    src, dst = (out.edges.select(F.col(c).alias("cell_id")).distinct() for c in ("src", "dst"))
    ends = src.intersect(dst).withColumn("in_graph", F.lit(True))
    known = out.pca.select("cell_id", (F.size("pc") > 0).alias("has_components"))
    cells = out.data.obs.select("cell_id", "all").join(sums, "cell_id", "left").join(ends, "cell_id", "left").join(known, "cell_id", "left")
    return cells.select("cell_id", "all", F.coalesce("n_genes", F.lit(0)).alias("n_genes"), r6(F.coalesce("sum_norm", F.lit(0.0))).alias("sum_norm"), F.coalesce("in_graph", F.lit(False)).alias("in_graph"), F.coalesce("has_components", F.lit(False)).alias("has_components"))


LISTS_SQL = """WITH l AS (SELECT DISTINCT p_brand AS list, CAST(p_size AS VARCHAR) || p_type AS gene FROM part UNION SELECT 'every', CAST(p_size AS VARCHAR) || p_type FROM part),
s AS (SELECT list, count(*) AS size FROM l GROUP BY 1),
o AS (SELECT a.list AS a, b.list AS b, count(*) AS k FROM l a JOIN l b ON a.gene = b.gene GROUP BY 1, 2),
t AS (SELECT x.list AS row_list, y.list AS col_list, x.size AS m, y.size AS n, COALESCE(k, 0) AS overlap FROM s x CROSS JOIN s y LEFT JOIN o ON a = x.list AND b = y.list)
"""


def _lists(spark, d) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_brand").alias("list"), F.concat(F.col("p_size").cast("string"), F.col("p_type")).alias("gene"))
    return p.union(p.select(F.lit("every"), "gene"))


@query(LISTS_SQL + "SELECT row_list, col_list, overlap, round(CASE WHEN row_list <> col_list THEN 100.0 * overlap / m END, 6) AS pct FROM t")
def list_overlap(spark, d):
    """SE5, SK10."""
    return rounded(cb.overlaps(_lists(spark, d)), "pct").select("row_list", "col_list", "overlap", "pct")


@query(LISTS_SQL + "SELECT row_list, col_list, CASE WHEN row_list = col_list THEN '' WHEN overlap = m AND overlap = n THEN '(=)' WHEN overlap = m THEN '(row<col)' WHEN overlap = n THEN '(row>col)' ELSE '' END AS relation FROM t")
def list_subset(spark, d):
    """SE6."""
    return cb.overlaps(_lists(spark, d)).select("row_list", "col_list", "relation")


# --- profiles ---------------------------------------------------------------------


@query("SELECT c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1")
def value_counts(spark, d):
    """AG11."""
    return ag.value_counts(table(spark, d, "customer"), "c_mktsegment")


PROFILED = ("c_custkey", "c_nationkey", "c_mktsegment")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, count(*) FILTER ({c} IS NULL) AS n_missing, CASE WHEN count(DISTINCT {c}) BETWEEN 1 AND 20 THEN (SELECT string_agg(v || '=' || n, ';' ORDER BY v) FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM customer WHERE {c} IS NOT NULL GROUP BY 1)) END AS listed FROM customer" for c in PROFILED
))
def profile_columns(spark, d):
    """AG13, AG15: with the counts of columns that have few values."""
    out = ag.profile(table(spark, d, "customer"), PROFILED)
    return out.select("column", "n_unique", "n_missing", F.array_join(F.transform("value_counts", lambda v: F.concat(v["value"], F.lit("="), v["count"].cast("string"))), ";").alias("listed"))


@query(CTE + "m AS (SELECT count(*) AS n_genes FROM var) SELECT min(value) AS min_value, max(value) AS max_value, round(avg(value), 6) AS mean_value, round(stddev_pop(value), 6) AS std_value, count(*) AS nnz, round(1 - count(*) / (max(n_cells) * CAST(max(n_genes) AS DOUBLE)), 6) AS sparsity FROM expr, n, m")
def matrix_profile(spark, d):
    """AG14, AG18."""
    x = dataset(spark, d)
    return rounded(ag.matrix_profile(x.expr, x.obs.count(), x.var.count()), "mean_value", "std_value", "sparsity")


@query(CTE + """l AS (SELECT 'X' AS layer, value FROM expr UNION ALL SELECT 'log', norm FROM lognorm),
t AS (SELECT layer, count(*) AS n, max(value) AS hi, round(avg(value), 6) AS mean_value, round(100 * avg(CASE WHEN value = floor(value) THEN 1 ELSE 0 END), 6) AS pct_whole FROM l WHERE value > 0 GROUP BY 1)
SELECT layer, n, mean_value, pct_whole, CASE WHEN pct_whole > 99 THEN 'counts' WHEN hi < 20 THEN 'log-normalised' ELSE 'ambiguous' END AS looks_like FROM t""")
def inspect_layers(spark, d):
    """AG17."""
    x = dataset(spark, d)
    both = x.expr.select("layer", "value").union(lognorm(x).select(F.lit("log"), "norm"))
    return rounded(ag.inspect_layers(both), "mean_value", "pct_whole").select("layer", "n", "mean_value", "pct_whole", "looks_like")


# --- kernels ----------------------------------------------------------------------

TOP = 500
HVG_SQL = CTE + """x AS (SELECT gene, exp(norm) - 1 AS x FROM lognorm), s AS (SELECT gene, SUM(x) AS s1, SUM(x * x) AS s2 FROM x GROUP BY 1),
m AS (SELECT gene, s1 / n_cells AS mean, greatest((s2 - n_cells * (s1 / n_cells) * (s1 / n_cells)) / (n_cells - 1), 0) AS v FROM s, n),
g AS (SELECT gene, ln(1 + mean) AS means, CASE WHEN v / mean > 0 THEN ln(v / mean) END AS dispersions FROM m),
e AS (SELECT min(means) AS lo, max(means) AS hi FROM g),
b AS (SELECT gene, means, dispersions, CAST(least(greatest(ceil(20 * (means - lo) / (hi - lo)), 1), 20) AS INTEGER) AS bin FROM g, e),
k AS (SELECT bin, avg(dispersions) AS mu, stddev_samp(dispersions) AS sd, count(dispersions) AS k FROM b GROUP BY 1),
z AS (SELECT gene, means, dispersions, b.bin, CASE WHEN k = 1 THEN 1.0 ELSE (dispersions - mu) / nullif(sd, 0) END AS z FROM b JOIN k USING (bin)),
r AS (SELECT *, rank() OVER (ORDER BY z DESC NULLS LAST) AS rk FROM z)
"""


@query(HVG_SQL + f"SELECT gene, round(means, 6) AS means, round(dispersions, 6) AS dispersions, bin, round(z, 6) AS dispersions_norm, z IS NOT NULL AND rk <= {TOP} AS highly_variable FROM r")
def hvg_seurat(spark, d):
    """NK4, NK6."""
    x = dataset(spark, d)
    return rounded(by_dispersion(lognorm(x), x.obs.count(), TOP), "means", "dispersions", "dispersions_norm")


@query(HVG_SQL + f"SELECT gene, round(z, 6) AS dispersions_norm FROM r ORDER BY z DESC NULLS LAST, gene LIMIT {TOP}")
def hvg_scores_sorted(spark, d):
    """SO1, SO2, SO3, SC8: a top-N report."""
    x = dataset(spark, d)
    return rounded(cb.top_genes(by_dispersion(lognorm(x), x.obs.count(), TOP), TOP), "dispersions_norm").select("gene", "dispersions_norm")


@query("SELECT gene FROM (SELECT CAST(l_partkey AS VARCHAR) AS gene, SUM(l_quantity) AS q FROM lineitem GROUP BY 1) ORDER BY q DESC, gene LIMIT 100")
def gene_list_topn(spark, d):
    """SC8, SO2: a top-N report."""
    scores = table(spark, d, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("gene")).agg(F.sum("l_quantity").alias("dispersions_norm"))
    return cb.top_genes(scores, 100).select("gene")


@query()
def hvg_seurat_v3(spark, d):
    """NK3, NK5; the local fit is not SQL."""
    x = dataset(spark, d)
    return rounded(by_standardised_variance(x.expr, x.obs.count(), TOP), "means", "variances", "variances_norm")


K = 15


def _knn(spark, d) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("label").alias("donor"), F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("pc"))
    return neighbours(e, K - 1)


@query(f"""WITH e AS (SELECT label, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
t AS (SELECT a.label AS donor, a.vec_id AS src, b.vec_id AS dst, list_distance(a.x, b.x) AS d FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY donor, src ORDER BY d, dst) AS rank FROM t)
SELECT donor, src, dst, round(d, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM r WHERE rank < {K}""")
def knn_per_group(spark, d):
    """NK8, JO9, SO4."""
    return rounded(_knn(spark, d), "distance")


@query()
def knn_descent(spark, d):
    """NK8 of large donors; which of the nearest are found isn't SQL."""
    e = table(spark, d, "embeddings").select(F.lit("all").alias("donor"), F.col("vec_id").alias("cell_id"), F.col("embedding").alias("pc"))
    return rounded(neighbours(e, K - 1, approximate_above=K), "distance")


@query()
def fuzzy_graph(spark, d):
    """NK9."""
    return rounded(fuzzy_edges(_knn(spark, d), K), "distance", "connectivity")


@query()
def pca_scores(spark, d):
    """NK7, after NK4: of the variable genes of the whole matrix; signs are arbitrary, so sizes are given."""
    x = dataset(spark, d)
    # The choice and the matrix read it: written once, it is joined, added up and normalised once.
    x = x.with_(expr=materialise(lognorm(x), "normalised"))
    scores = by_dispersion(x.expr, x.obs.count(), TOP_GENES)
    few = fi.keep_genes(x, materialise(scores.filter("highly_variable").select("gene"), "chosen"))
    return components(few).select("cell_id", F.transform("pc", lambda v: F.round(F.abs(v), 6)).alias("pc"))


# --- slices, reports, entry B -----------------------------------------------------

@query(CTE_ONLY + "SELECT cell_id, count(*) AS n_genes, sum(value) AS total FROM expr JOIN obs USING (cell_id) WHERE donor = 3 GROUP BY 1")
def donor_slice(spark, d):
    """FI5."""
    x = fi.donor_slice(dataset(spark, d), "donor", 3)
    return x.expr.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_genes"), F.sum("value").alias("total"))


@query("SELECT CAST(floor(c_acctbal / 7) AS BIGINT) AS donor, count(*) AS n_cells FROM customer GROUP BY 1 HAVING count(*) = 1")
def skipped_donors(spark, d):
    """FI6: the donors that the log names."""
    obs = table(spark, d, "customer").select(F.floor(F.col("c_acctbal") / 7).cast("long").alias("donor"))
    return rp.skipped_donors(obs, "donor")


@query("SELECT o_orderkey FROM orders WHERE CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END")
def flag_rows(spark, d):
    """FI8: a missing flag is false."""
    status = F.col("o_orderstatus")
    rows = table(spark, d, "orders").select("o_orderkey", F.when(status == "F", True).when(status == "O", False).alias("flag"))
    return fi.flagged(rows, "flag").select("o_orderkey")


@query("SELECT o_custkey, o_orderkey, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey DESC) AS r FROM orders) WHERE r <= 3")
def group_top_rows(spark, d):
    """SO7."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return fi.top_rows(rows, "o_custkey", [F.col("o_orderpriority"), F.col("o_orderkey").desc()], 3).select("o_custkey", "o_orderkey", "rank")


@query(CTE_ONLY + "SELECT 'X' AS layer, count(*) AS n, round(count(*) / ((SELECT count(*) FROM obs) * CAST((SELECT count(*) FROM var) AS DOUBLE)), 6) AS density FROM expr WHERE value > 0")
def layer_density(spark, d):
    """AG17."""
    x = dataset(spark, d)
    return rounded(ag.inspect_layers(x.expr, x.obs.count(), x.var.count()), "density").select("layer", "n", "density")


@query(CTE_ONLY + "SELECT c.cell_id, g.gene, COALESCE(value, 0) AS value FROM (SELECT cell_id FROM obs ORDER BY cell_ord LIMIT 20) c CROSS JOIN (SELECT gene FROM var ORDER BY gene_ord LIMIT 20) g LEFT JOIN expr e ON e.cell_id = c.cell_id AND e.gene = g.gene")
def corner_preview(spark, d):
    """SO5."""
    return rp.preview(dataset(spark, d), 20, 20)


@query(CTE_ONLY + "SELECT avg(CASE WHEN value = floor(value) THEN 1.0 ELSE 0.0 END) AS share FROM (SELECT * FROM expr WHERE value > 0 ORDER BY cell_id, gene LIMIT 1000)")
def whole_share_first(spark, d):
    """PR11: its thousand values are the feature."""
    return rp.whole_share_of_first(dataset(spark, d).expr)


@query(CTE_ONLY + """SELECT t.part, t.col AS "column", CASE t.part WHEN 'expr' THEN (SELECT count(*) FROM expr) WHEN 'obs' THEN (SELECT count(*) FROM obs) ELSE (SELECT count(*) FROM var) END AS n_rows
FROM (VALUES ('expr', 'cell_id'), ('expr', 'gene'), ('expr', 'value'), ('expr', 'layer'), ('obs', 'cell_id'), ('obs', 'cell_ord'), ('obs', 'donor'), ('obs', 'subtype'), ('obs', 'major'), ('var', 'gene'), ('var', 'gene_ord'), ('var', 'brand')) t(part, col)""")
def structure_report(spark, d):
    """AG15."""
    return rp.structure(dataset(spark, d)).select("part", "column", "n_rows")


@query(f"""SELECT p_partkey, CASE p_partkey % 9 {' '.join(f"WHEN {i} THEN {v}" for i, v in enumerate(BRAAK.values()))} END AS braak,
CASE p_partkey % 7 {' '.join(f"WHEN {i} THEN {v}" for i, v in enumerate(CERAD.values()))} END AS cerad, CASE WHEN p_partkey % 8 < 7 THEN CAST(p_partkey % 8 AS INTEGER) END AS thal FROM part""")
def stage_scores(spark, d):
    """PR4: stages of the three scales, and texts that are none."""
    key = F.col("p_partkey")
    text = lambda names, n: F.try_element_at(F.array(*(F.lit(x) for x in names)), (key % n + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", *(ordinal(F.coalesce(text(s, n), F.lit("odd")), s).alias(c) for c, s, n in (("braak", BRAAK, 9), ("cerad", CERAD, 7), ("thal", THAL, 8))))


def _both_sql(k: str, name: str) -> str:
    return STATS_SQL.format(k=k).replace("sizes", f"{name}_sizes").replace("sums", f"{name}_sums").replace("stats AS", f"{name} AS")


@query(CTE + _both_sql("subtype", "by_subtype").rstrip() + ",\n" + _both_sql("major", "by_major") + """SELECT CAST(donor AS VARCHAR) AS donor_id, granularity, cell_type, gene AS gene_symbol, round(CAST(CAST(mean_expr AS FLOAT) AS DOUBLE), 4) AS mean_expr, round(CAST(CAST(frac_expressed AS FLOAT) AS DOUBLE), 4) AS frac_expressed, CAST(n_cells AS INTEGER) AS n_cells
FROM (SELECT 'subtype' AS granularity, * FROM by_subtype UNION ALL SELECT 'major', * FROM by_major)""")
def class_statistics(spark, d):
    """Entry B: a dataset a class, both granularities, merged (AG2-AG6, SE4, PR20)."""
    x = dataset(spark, d)
    parts = []
    for major in sorted(set(SEGMENTS.values())):
        obs = x.obs.filter(F.col("major") == major)
        parts.append(class_stats(x.with_(obs=obs, expr=x.expr.join(obs.select("cell_id"), "cell_id", "left_semi")), major, "donor", "subtype"))
    out = as_written(ag.merge_stats(reduce(DataFrame.unionByName, parts)))
    return out.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("mean_expr", "frac_expressed")})
