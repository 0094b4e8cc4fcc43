"""A training-data pipeline: quality, near duplicates, repeated passages, benchmarks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cytospark.llm.decontaminate import contaminated
from cytospark.llm.near_dedup import near_duplicates
from cytospark.llm.packing import pack_documents
from cytospark.llm.quality import quality_scores
from cytospark.scratch import materialise
from cytospark.llm.substring_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents that score less are rejected.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose calibrated quality is LEAST_QUALITY or more, whatever their ids.

    All labels of documents that are there take part in the fit. Null and empty texts are
    scored as texts without words, very long ones whole, and rows that repeat each by itself. An
    empty table gives an empty one; further columns are dropped.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    scores = quality_scores(docs, labels, fold, held_out_fold=-1, carry=COLUMNS[1:])
    return scores.filter(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least row of each group of near duplicates, by id, null ids last, then the row that was read first.

    Each row is judged by itself, so texts that share an id, or have none, fall only to their
    own near duplicates; equal rows are near duplicates. Blank and null texts have none
    and all stay. Texts of any length are compared whole; an empty table gives an empty one,
    and further columns are dropped.
    """
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS), "rows")
    blank = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    nodes = near_duplicates(rows.filter(~blank).withColumnRenamed("doc_id", "id"), id_col="row", carry=("id",))
    first = lambda: F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))
    least = nodes.select("component_id", "id", F.col("doc_id").alias("row")).groupBy("component_id").agg(first().alias("least"))
    kept = rows.filter(~blank).join(least.select("least.row"), "row", "left_semi")
    return kept.unionByName(rows.filter(blank)).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the words of 20-word windows that start earlier elsewhere.

    A text that loses words is what is left, joined by single spaces; others are unchanged.
    Null ids come first, rows that share an id are in the order of a hash of their texts. Null and
    empty texts stay as they are, very long ones are read whole, and a text may lose all its words.
    An empty table gives an empty one; further columns are dropped.
    """
    out = remove_repeats(docs, carry=("text", "lang", "source", "n_chars"))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    return out.select("doc_id", text.alias("text"), "lang", "source", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found, whatever their ids.

    Null and empty texts hold none and stay; texts of any length are searched whole; equal rows stay
    or go together. An empty table, or an empty benchmark, changes nothing; further columns are dropped.
    """
    docs = docs.select(*COLUMNS, F.sha2("text", 256).alias("digest"))
    hits = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=("digest",))
    hits = hits.select(F.col("doc_id").alias("other_id"), F.col("digest").alias("other_digest")).distinct()
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["other_id"]) & (docs["digest"] == hits["other_digest"]), "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 2048 tokens.

    Null and empty texts have an end token alone, very long ones are cut into pieces, and rows
    that share an id or have none are packed as documents of their own. An empty table gives no
    piece; further columns are ignored.
    """
    out = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't state the classifier or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
