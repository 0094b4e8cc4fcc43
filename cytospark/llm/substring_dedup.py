"""Removal of repeated token windows (exact substring deduplication).

Every window of ``window`` consecutive words gets two Rabin-Karp hashes, 64 bits and as many
more as the corpus needs so that unlike windows are held to be equal about never (SPARE_BITS
says how rarely). Documents are
grouped into blocks of ascending id; each block sends its distinct window hashes to
buckets, and each bucket answers which of them the block holds first. A window that
starts earlier anywhere else is repeated; runs of repeated windows merge into maximal
removal intervals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .blocks import bucket_slices, ordered_blocks, pack_sorted, pieces, unpack_sorted
from .textkit import U64, batches_of_bytes, span_hashes, text_bytes, trim, window_hashes, word_spans

#: Bytes of text that one block holds at most, and that are hashed at a time; a bucket holds the windows of twice a block.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
#: Two unlike windows of the whole corpus have equal hashes with a chance of about 2**-SPARE_BITS.
SPARE_BITS = 10

RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"


def _in_order(table: pa.Table) -> pa.Table:
    """Rows by id, nulls first, then place, then text."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("place", "ascending"), ("text", "ascending")], null_placement="at_start"))


def _windows(table: pa.Table, window: int, more_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of the texts in their order (64 bits, and up to 32 more), and the number of each text's words."""
    data, offsets = text_bytes(table["text"])
    hashes, more, counts = [np.zeros(0, U64)], [np.zeros(0, np.uint32)], np.zeros(table.num_rows, np.int64)
    for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
        part = data[offsets[i] : offsets[j]]
        starts, ends, doc = word_spans(part, offsets[i : j + 1] - offsets[i])
        counts[i:j] = np.bincount(doc, minlength=j - i)
        words = span_hashes(part, starts, ends)
        h = window_hashes(words, window)
        if len(h):
            inside = doc[: len(h)] == doc[window - 1 :]
            hashes.append(h[inside])
            if more_bytes:
                other = window_hashes(span_hashes(part, starts, ends, seed=2), window)[inside]
                more.append((other >> U64(64 - 8 * more_bytes)).astype(np.uint32))
            else:
                more.append(np.zeros(int(inside.sum()), np.uint32))
    return np.concatenate(hashes), np.concatenate(more), counts


def _ranked(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of the hashes by (high, low), and whether each in it differs from the one before."""
    order = np.argsort(high, kind="stable")
    h, w = high[order], low[order]
    same, other = h[1:] == h[:-1], w[1:] != w[:-1]
    if (same & other).any():
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
        same, other = h[1:] == h[:-1], w[1:] != w[:-1]
    return order, np.r_[np.ones(min(1, len(order)), bool), ~same | other]


def _spans(repeated: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of words that repeated windows cover."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return at, at
    gap = np.flatnonzero(at[1:] > at[:-1] + window)
    return at[np.r_[0, gap + 1]], at[np.r_[gap, len(at) - 1]] + window


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, block_bytes: int = BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Remove every word that lies in a window whose word sequence also starts earlier.

    Earlier is a smaller id, or the same document at an earlier word; windows are judged
    on the input. Returns doc_id, n_words, n_removed, the removed ``spans`` (word
    positions, end exclusive) and the ``kept`` words joined by one space.

    Null or blank texts have no words and an empty ``kept``. Rows with a null id come
    before all others; rows that share an id are separate documents ordered by a hash of the text. Very long
    texts are hashed whole. An empty table gives an empty result. Other columns are
    ignored, whatever their names, but for those in ``carry``, which follow the result's.
    """
    extra = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(x) for c, x in zip(carry, extra)))
    kinds = StructType([StructField(x, docs.schema[x].dataType, True) for x in extra])
    result = StructType([*StructType.fromDDL(RESULT).fields, *kinds.fields])
    empty = to_arrow_schema(result).empty_table()
    blocked, total = ordered_blocks(docs, "doc_id", "text", block_bytes)
    n_buckets = pieces(total, 2 * block_bytes)
    # A window needs two bytes of text at least.
    more_bytes = int(np.clip(-(-(2 * (total // 2 + 1).bit_length() - 1 + SPARE_BITS - 64) // 8), 0, 4))

    def send(table: pa.Table) -> pa.Table:
        trim()
        high, low, _ = _windows(_in_order(table), window, more_bytes)
        order, new = _ranked(high, low)
        keys, more = high[order[new]], low[order[new]]
        planes = more.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :more_bytes]
        rows = [(b, pack_sorted(keys[s]), planes[s].tobytes()) for b, s in bucket_slices(keys, n_buckets)]
        block = table["block"][0].as_py()
        return pa.table({"block": pa.array([block] * len(rows), pa.int32()), "bucket": pa.array([r[0] for r in rows], pa.int32()), "keys": pa.array([r[1] for r in rows], pa.binary()), "more": pa.array([r[2] for r in rows], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        trim()
        table = table.sort_by("block")
        parts = [unpack_sorted(x.as_buffer().to_pybytes()) for x in table["keys"]]
        ends = np.cumsum([len(p) for p in parts])
        planes = np.zeros((int(ends[-1]), 4), np.uint8)
        planes[:, :more_bytes] = np.frombuffer(b"".join(table["more"].to_pylist()), np.uint8).reshape(-1, more_bytes) if more_bytes else 0
        more = planes.view("<u4").ravel()
        order, new = _ranked(np.concatenate(parts), more)
        again = np.zeros(len(order), bool)
        again[order] = ~new
        flags = [np.packbits(f).tobytes() for f in np.split(again, ends[:-1])]
        return pa.table({"block": table["block"], "bucket": table["bucket"], "again": pa.array(flags, pa.binary())})

    def apply(table: pa.Table, answers: pa.Table) -> pa.Table:
        trim()
        if not table.num_rows:
            return empty
        table = _in_order(table)
        high, low, counts = _windows(table, window, more_bytes)
        order, new = _ranked(high, low)
        keys = high[order[new]]
        flags = dict(zip(answers["bucket"].to_pylist(), answers["again"].to_pylist()))
        again = np.zeros(len(keys), bool)
        for b, s in bucket_slices(keys, n_buckets):
            again[s] = np.unpackbits(np.frombuffer(flags[b], np.uint8), count=s.stop - s.start).astype(bool)
        # The order is stable, so the first of equal windows is the earliest.
        repeated = np.empty(len(order), bool)
        repeated[order] = again[np.cumsum(new) - 1] | ~new
        at, removed, spans, kept = 0, [], [], []
        for text, n in zip(table["text"], counts):
            m = max(0, int(n) - window + 1)
            lo, hi = _spans(repeated[at : at + m], window)
            at += m
            words = (text.as_py() or "").encode().split()
            if len(lo):
                gone = np.zeros(n, bool)
                for a, b in zip(lo, hi):
                    gone[a:b] = True
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            removed.append(int(n) - len(words))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(lo, hi)])
            kept.append(b" ".join(words).decode())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(counts), "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.string()), **{x: table[x] for x in extra}})

    sent = blocked.groupBy("block").applyInArrow(send, "block int, bucket int, keys binary, more binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "block int, bucket int, again binary")
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, result).withColumnsRenamed(dict(zip(extra, carry)))
