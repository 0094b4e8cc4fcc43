"""The queries of the numbered operators; their SQL, where SQL can state them, is ``ORACLE_SQL``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .arrow_sequences import read_documents, write_sequences
from .cover_tree import top_k
from .decontaminate import contaminated
from .divergence_audit import divergence
from .language_crf import identify
from .lm_scoring import score
from .near_dedup import near_duplicates
from .oracle import ORACLE_SQL
from .packing import pack_documents
from .permutation_index import nearest
from .quality import quality_scores
from .resampling import resample
from ..scratch import scratch_path
from .substring_dedup import remove_repeats
from .url_filters import match_captures, url_host


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 20-word windows removed from every document."""
    out = remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at 75 % of their 5-word shingles, with components."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation trigram scores of all documents."""
    return score(_table(spark, sf_dir, "documents"), _fold(7), folds=7, scored_fold=2, deleted_fold=3)


def op5_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token sequences in Arrow files, and what the files give back."""
    out_dir = scratch_path(spark, "sequences")
    shards = write_sequences(_table(spark, sf_dir, "documents"), out_dir, _tokenizer("byte_bpe_50k.json"), end_id=0)
    return read_documents(shards, out_dir).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per pair."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by a conditional random field over words."""
    return identify(_table(spark, sf_dir, "documents"), _fold(5)).select("doc_id", "held_out", "lang_pred", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality scores of all documents."""
    out = quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _fold(5))
    return out.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def _number(text, digits: int = 6):
    """A number from a text's MD5, the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against a dated block list.

    The tables hold neither fetch times nor lists, so both follow from a rule: a page is
    fetched on a day of 2024 that its URL's MD5 gives; half of the hosts, their parent
    domains and sections enter the list, some leave it, and some return.
    """
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    pages = pages.withColumn("fetched_at", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(_number(F.col("url")), F.lit(366)).cast("int")))
    host = url_host(F.col("url"))
    section = F.concat_ws("/", host, F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1))
    parent = F.regexp_extract(host, r"^[^.]+\.(.+)$", 1)
    entries = pages.select(F.explode(F.array(host, section, parent)).alias("entry")).filter("entry is not null and entry <> ''").distinct()
    n = _number(F.col("entry"))
    entries = entries.filter(n % 2 == 0).withColumn("n", n)
    day = lambda shift: F.date_add(F.lit("2024-01-01").cast("date"), (F.floor(F.col("n") / 7) % 180 + shift).cast("int"))
    events = entries.select("entry", F.lit("add").alias("action"), day(0).alias("at"))
    events = events.unionByName(entries.filter("n % 3 < 2").select("entry", F.lit("remove").alias("action"), day(60).alias("at")))
    events = events.unionByName(entries.filter("n % 3 = 1").select("entry", F.lit("add").alias("action"), day(120).alias("at")))
    return match_captures(pages, events)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    out = pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of each language against each other, and the terms each favours."""
    return divergence(_table(spark, sf_dir, "documents"))


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every 100th one, exactly."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words; every document with its score."""
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_permutation_index": op1_permutation_index,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_arrow_sequences": op5_arrow_sequences,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_url_filters": op9_url_filters,
    "op10_packing": op10_packing,
    "op11_divergence_audit": op11_divergence_audit,
    "op12_cover_tree": op12_cover_tree,
    "op13_importance_resampling": op13_importance_resampling,
}
