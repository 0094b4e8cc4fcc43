"""Importance resampling of documents towards a target collection.

Runs of words are hashed into buckets. A bucket's gain is the log of how much commoner it is
in the target than in the corpus; a document weighs the mean gain of its features, and
Gumbel noise from its id makes the highest scores a draw without replacement in
proportion to exp(weight).

Higher-order functions turn each text into its array of buckets and fold that array over a
literal array of gains, so no row is made per feature to score it. Only counts per
bucket are shuffled, at most one row a bucket from each task, and then the few numbers of
the documents that may be drawn.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.numbering import numbered
from ..scratch import materialise

#: What is between words: ASCII other than letters and digits.
BETWEEN = "".join(c for c in map(chr, range(128)) if c not in string.ascii_letters + string.digits)
#: Gains and scores are whole thousandths.
UNIT = 1000


def _words(text_col: str) -> Column:
    """Words with A-Z lower-cased; one pass over the letters also makes all that is between words a space."""
    plain = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), string.ascii_uppercase + BETWEEN, string.ascii_lowercase + " " * len(BETWEEN))
    return F.array_remove(F.split(plain, " "), "")


def _buckets(words: str, longest: int, buckets: int) -> Column:
    """Bucket of every run of 1 to ``longest`` consecutive words."""
    runs, last = F.col(words), F.col(words)
    for n in range(2, longest + 1):
        # A run of n words is one of n - 1 and the word after it; the last one has none.
        last = F.zip_with(last, F.slice(words, n, F.greatest(F.size(words), F.lit(0))), lambda run, word: F.concat(run, F.lit(" "), word))
        last = F.slice(last, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
        runs = F.concat(runs, last)
    return F.transform(runs, lambda run: F.pmod(F.crc32(F.encode(run, "UTF-8")), F.lit(buckets)).cast("int"))


def _counts(texts: DataFrame, buckets: int) -> list[int]:
    """Features in each bucket; each task sums its own first."""
    rows = texts.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count().collect()  # at most one row a bucket
    out = [0] * buckets
    for r in rows:
        out[r["bucket"]] = r["count"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Floored thousandths of the log ratio of the smoothed shares, bucket by bucket."""
    n, s, t = len(corpus), sum(corpus), sum(target)
    return [math.floor(UNIT * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(corpus, target)]


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = 10000,
    longest: int = 1,
    least_words: int = 20,
    seed: int = 2024,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document, with its place in the draw or null.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred (rounded down)
    are drawn by score, ties to the smaller id, then to the row that was written first.
    Columns in ``carry`` follow, so that ``rank is not null`` gives the drawn texts.

    A null or wordless text has no features and weight 0. A null id counts as empty text in the
    noise and comes after all ids where scores tie. Rows that share an id are documents of their own with
    equal noise; equal rows get different ranks. Very long texts are scored whole. An empty
    target gives gains against no counts; empty documents give an empty result. Other
    columns are ignored, whatever their names.
    """
    extra = [f"carried_{i}" for i in range(len(carry))]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _words(text_col).alias("words"), *(F.col(c).alias(x) for c, x in zip(carry, extra)))
    rows = rows.select("doc_id", F.size("words").alias("n_words"), _buckets("words", longest, buckets).alias("buckets"), *extra)
    aim = target.select(_words(target_text_col).alias("words")).select(_buckets("words", longest, buckets).alias("buckets"))
    # One constant, folded into a literal array when the plan is optimised.
    table = F.split(F.lit(" ".join(map(str, gains(_counts(rows, buckets), _counts(aim, buckets))))), " ").cast("array<bigint>")

    n = F.col("n_features")
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda acc, b: acc + F.element_at(table, b + 1))
    scored = rows.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), total.alias("total"), *extra)
    weight = F.when(n == 0, F.lit(0).cast("long")).otherwise(F.expr("(total - pmod(total, n_features)) div n_features"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-float(UNIT) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = scored.select("doc_id", "n_words", "n_features", weight.alias("weight"), noise.alias("noise"), *extra)
    scored = scored.select("doc_id", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"), (F.col("n_words") >= least_words).alias("fit"), F.monotonically_increasing_id().alias("row"), *extra)
    scored = materialise(scored, "scored")

    # Scores are whole numbers within some tens of thousands, so their counts are few.
    steps = scored.filter("fit").groupBy("score").count().orderBy(F.desc("score")).collect()
    drawn, cut, above = percent * sum(r["count"] for r in steps) // 100, None, 0
    for r in steps:
        if above >= drawn:
            break
        cut, above = r["score"], above + r["count"]
    out = ["doc_id", "n_features", "weight", "score"]
    may = F.col("fit") & (F.col("score") >= cut) if cut is not None else F.lit(False)
    ranked = numbered(scored.filter(may), [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "rank", 1)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    both = ranked.select(*out, rank.alias("rank"), *extra).unionByName(scored.filter(~may).select(*out, F.lit(None).cast("long").alias("rank"), *extra))
    return both.withColumnsRenamed(dict(zip(extra, carry)))
