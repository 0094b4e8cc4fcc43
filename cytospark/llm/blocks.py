"""Blocks of documents and the exchange of packed 64-bit keys between them.

Several operators must know, for every word window or n-gram of a document, what the
rest of the corpus says about it. One row per occurrence would be shuffled twice. Here
a block (some MB of documents) sends its sorted distinct keys once, cut into buckets
by key range and stored as differences, and each bucket answers every block in that
block's own order, so the answer needs no keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType

U64 = np.uint64


#: Bytes that a document counts for besides its text.
_ROW_BYTES = 16


def corpus_size(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows and text bytes."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def drawn(key: Column, most: float, n: int | float) -> Column:
    """Whether a row is among about ``most`` of ``n``, by a 64-bit hash ``key``; this never falls to none."""
    if most >= n:
        return key.isNotNull()
    return key < F.lit(int(most * (1 << 64) / n) - (1 << 63))


def pieces(total: int, most: int, spread: int = 256) -> int:
    """Number of blocks of at most ``most`` bytes; a small corpus is spread over up to ``spread`` of a sixteenth of that or more."""
    return max(1, -(-total // max(1, min(most, max(most // 16, total // spread)))))


def ordered_blocks(docs: DataFrame, id_col: str, text_col: str, most_bytes: int, knots: int = 2048) -> tuple[DataFrame, int]:
    """``docs`` with ``block`` and ``place``, and the text bytes.

    Documents are ordered by id, nulls first, then by ``place``, a hash of the text;
    those of a lower block come first. Blocks hold about equal bytes, also where ids
    are unevenly dense, an id is repeated very often or texts differ in length. At most
    ``knots`` quantiles of the id reach the driver; between two of them the blocks
    divide the id range evenly.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(_ROW_BYTES)
    row = docs.agg(F.sum(size).alias("b"), F.sum(F.when(F.col(id_col).isNull(), size)).alias("nameless")).first()
    total, nameless = int(row["b"] or 0), int(row["nameless"] or 0)
    n_blocks = pieces(total, most_bytes)
    first = -(-nameless * n_blocks // total) if nameless else 0
    cuts = max(1, min(n_blocks - first, knots))
    per = max(1, -(-(n_blocks - first) // cuts))
    # An id enters the quantiles once for each ``unit`` bytes that it has, by chance where that is a fraction.
    unit = max(1.0, (total - nameless) / (64.0 * cuts))
    weight = F.floor(size / F.lit(unit) + F.rand(7)).cast("int")
    sample = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), weight.alias("w")).filter("w > 0")
    shares = [i / cuts for i in range(cuts + 1)]
    found = sample.select("id", F.explode(F.sequence(F.lit(1), "w"))).agg(F.percentile_approx("id", shares, 20 * cuts + 1000).alias("q")).first()["q"]
    bounds = np.array(found or [0] * (cuts + 1), dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def block_of(ids: pd.Series, place: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        x = ids.fillna(0).astype("int64").to_numpy()
        share = (place.to_numpy().view(U64) >> U64(11)).astype(np.float64) * 2.0**-53
        inner = bounds[1:-1]
        low, high = np.searchsorted(inner, x, side="left"), np.searchsorted(inner, x, side="right")
        lo, hi = bounds[high].astype(np.float64), bounds[high + 1].astype(np.float64)
        even = high * per + np.clip(np.floor((x - lo) / np.maximum(hi - lo, 1) * per), 0, per - 1)
        # An id that fills several blocks is dealt out to them by its rows' places.
        often = (low + 1) * per + np.floor(share * (high - low) * per)
        named = first + np.where(high - low > 1, often, even)
        return pd.Series(np.where(known, named, np.floor(share * max(first, 1))).astype(np.int32))

    docs = docs.withColumn("place", F.shiftrightunsigned(F.xxhash64(text_col), 1))
    return docs.withColumn("block", block_of(F.col(id_col), F.shiftleft("place", 1))), total


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket by key range: ascending with the key."""
    return (((keys >> U64(32)) * U64(n_buckets)) >> U64(32)).astype(np.int64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending distinct keys as a first value and differences of as few bytes as will do."""
    step = np.diff(keys)
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(step) else 1
    planes = step.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return keys[:1].astype("<u8").tobytes() + bytes([width]) + planes.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    """The keys that ``pack_sorted`` was given."""
    width = data[8]
    planes = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    out = np.zeros((len(planes) + 1, 8), np.uint8)
    out[1:, :width] = planes
    out[0] = np.frombuffer(data, np.uint8, count=8)
    return np.cumsum(out.view("<u8").ravel(), dtype=U64)


def bucket_slices(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that ascending ``keys`` touch, with the slice of each."""
    if len(keys):
        b = bucket_of(keys, n_buckets)
        at = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        for i, j in zip(at, [*at[1:], len(keys)]):
            yield int(b[i]), slice(int(i), int(j))
