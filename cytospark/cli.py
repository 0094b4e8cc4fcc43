"""Command line: ``python -m cytospark.cli COMMAND ...``; any error is logged and ends with 1."""

from __future__ import annotations

import argparse
import json
import logging
import sys
from dataclasses import asdict, replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config
from .model import Dataset
from .operators import columns, combine, joins
from .operators.categories import categorise
from .operators.report import check, preview
from .plans import aggregate
from .plans.feature import features
from .sources.clustered import read_layout, write_clustered
from .sources.files import check_path, label_of, read_compared_list, read_dataset, read_gene_list, read_table, var_names, write_list
from .sources.runs import write_scores
from .sources.store import put_text
from .sources.versions import commit, current


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cytospark")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("categories", help="columns as categories, counts as integers")
    c.add_argument("input"), c.add_argument("output"), c.add_argument("--columns", nargs="*", default=[])
    c.add_argument("--keep-raw", action="store_true"), c.add_argument("--no-cast-int", action="store_true")
    c = sub.add_parser("metadata", help="join a clinical table")
    c.add_argument("input"), c.add_argument("table"), c.add_argument("output", nargs="?", help="without it, in place")
    c.add_argument("--key-table", help="a table that gives each cell's donor id by individual, joined first")
    c = sub.add_parser("columns", help="harmonise annotation columns")
    c.add_argument("input"), c.add_argument("output", nargs="?", help="without it, in place"), c.add_argument("--kind", choices=("cohort", "per_class", "atlas"), required=True)
    c.add_argument("--cell-class"), c.add_argument("--cell-type")
    c = sub.add_parser("combine", help="concatenate datasets")
    c.add_argument("inputs", nargs="+"), c.add_argument("--output", required=True)
    c.add_argument("--join", default="outer"), c.add_argument("--merge", default="unique")
    c.add_argument("--no-graphs", action="store_true", help="leave the inputs' neighbour graphs out")
    c = sub.add_parser("features", help="QC to neighbour graph")
    c.add_argument("input"), c.add_argument("output"), c.add_argument("--layer"), c.add_argument("--raw", action="store_true")
    c.add_argument("--genes"), c.add_argument("--top-of-list", type=int), c.add_argument("--top-after-normalising", type=int)
    c.add_argument("--n-genes", type=int), c.add_argument("--k-neighbors", type=int), c.add_argument("--individual-pca", action="store_true")
    c.add_argument("--exact-neighbors", action="store_true", help="compare all pairs in large donors too")
    c = sub.add_parser("aggregate", help="statistics per donor and cell type")
    c.add_argument("--input-dir", required=True), c.add_argument("--output-dir", required=True), c.add_argument("--clinical-csv", required=True)
    c.add_argument("--individuals-csv"), c.add_argument("--resume", action="store_true")
    c.add_argument("--keep-intermediate", action="store_true"), c.add_argument("--single-file", action="store_true")
    c.add_argument("--major", nargs="+", required=True, metavar="NAME=CLASS")
    c = sub.add_parser("store", help="store by cell, so that work by cell needs no shuffle")
    c.add_argument("input"), c.add_argument("output", nargs="?", help="without it, in place"), c.add_argument("--buckets", type=int)
    c = sub.add_parser("validate", help="show structure and profile; ends with 1 where something is wrong")
    c.add_argument("input"), c.add_argument("--no-columns", action="store_true"), c.add_argument("--no-matrix", action="store_true"), c.add_argument("--preview", type=int, default=0)
    c = sub.add_parser("genes", help="names of a dataset's genes, one a line")
    c.add_argument("input"), c.add_argument("output")
    c = sub.add_parser("overlap", help="text table of the overlaps of gene lists")
    c.add_argument("lists", nargs="+"), c.add_argument("--group", action="append", default=[], metavar="NAME=LABEL,LABEL")
    return p


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    settings = (Config.load(a.config) if a.config else Config()).processing
    if a.command == "categories":
        data = read_dataset(spark, a.input)
        data = data if a.keep_raw else columns.drop_raw(data)
        expr = data.expr if a.no_cast_int else columns.cast_counts(data.expr)
        categorise(data.with_(expr=expr), a.columns).write(a.output)
    elif a.command == "metadata":
        data = read_dataset(spark, a.input)
        obs = joins.add_metadata(data.obs, read_table(spark, a.key_table)) if a.key_table else data.obs
        write(spark, data.with_(obs=joins.add_metadata(obs, read_table(spark, a.table)), var=columns.drop_reserved(data.var)), a)
    elif a.command == "columns":
        data = read_dataset(spark, a.input)
        write(spark, data.with_(obs=columns.harmonise(data.obs, a.kind, a.cell_class, a.cell_type)), a)
    elif a.command == "combine":
        combine.concat({p: read_dataset(spark, p) for p in a.inputs}, a.join, a.merge, pairwise=not a.no_graphs).write(a.output)
    elif a.command == "features":
        given = {"top": a.n_genes, "k": a.k_neighbors, "by_donor": a.individual_pca or None}
        settings = replace(settings, **{k: v for k, v in given.items() if v is not None})
        out = features(
            read_dataset(spark, a.input), layer=a.layer, use_raw=a.raw, genes=read_gene_list(spark, a.genes) if a.genes else None,
            top_of_list=a.top_of_list, top_after_normalising=a.top_after_normalising, **asdict(settings),
            **({"approximate_above": None} if a.exact_neighbors else {}),
        )
        out.data.write(f"{a.output}/data")
        out.pca.write.parquet(f"{a.output}/pca")
        if out.scores is not None:
            write_scores(out.scores, a.output)
        put_text(spark, f"{a.output}/config.json", json.dumps(asdict(settings), indent=2))
        out.close()
    elif a.command == "aggregate":
        aggregate.run(spark, a.input_dir, a.output_dir, a.clinical_csv, dict(x.split("=", 1) for x in a.major), a.individuals_csv, a.resume, a.keep_intermediate or not a.single_file, a.single_file)
    elif a.command == "store":
        store = partial(write_clustered, read_dataset(spark, a.input), buckets=a.buckets)
        store(a.output) if a.output else commit(spark, store, a.input)
    elif a.command == "genes":
        write_list(var_names(spark, a.input), a.output)
    elif a.command == "overlap":
        lists = {label_of(spark, p): read_compared_list(spark, p) for p in a.lists}
        rows = reduce(DataFrame.unionByName, [g.select(F.lit(n).alias("list"), "gene") for n, g in lists.items()])
        order = combine.group_lists(list(lists), {n: m.split(",") for n, m in (x.split("=", 1) for x in a.group)})
        print(combine.overlap_table(combine.overlaps(rows), [x for _, x in order]))
    else:
        check_path(spark, a.input)
        data = read_dataset(spark, a.input)
        report = check(data, not a.no_columns, not a.no_matrix)
        print(report.text())
        if a.preview:
            preview(data, a.preview, a.preview).show(a.preview**2, truncate=40)
        if not report.ok:
            raise ValueError("; ".join(report.problems))


def write(spark: SparkSession, data: Dataset, a: argparse.Namespace) -> None:
    """To the output, or as a new version of the input, by cell if that is so stored."""
    if a.output:
        data.write(a.output)
    else:
        layout = read_layout(spark, current(spark, a.input))
        commit(spark, partial(write_clustered, data, buckets=layout["buckets"]) if layout else data.write, a.input)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        run(SparkSession.builder.getOrCreate(), a)
    except Exception:
        logging.getLogger("cytospark").exception("%s failed", a.command)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
