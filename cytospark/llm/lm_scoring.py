"""Language-model scores by deleted interpolation of n-gram maximum-likelihood estimates.

P(w | u v) = a_k f(w | u v) + b_k f(w | v) + c_k f(w) + d_k / (V + 1), where f are relative
frequencies, k is the frequency bucket of the context (u v, or v where u v was not seen),
and the weights of each bucket come from expectation-maximisation on held-out counts: the
training documents are split into a retained part, whose counts give the estimates during
learning, and a deleted part, whose tokens the weights are fitted to. Scores then use the
counts of both parts.

Counts travel packed: a block sends each distinct n-gram once, with its count, and gets
the corpus totals back in its own order. Words are told apart by 64-bit hashes. Longer
n-grams have hashes just long enough that, in a corpus of this size, one that was not
seen is taken for another once in about 2**SPARE_BITS look-ups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .blocks import bucket_slices, corpus_size, pack_sorted, pieces, unpack_sorted
from ..scratch import discard, materialise
from .textkit import U64, batches_of_bytes, mix, span_hashes, text_bytes, word_spans

BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
ORDERS = 3
SPARE_BITS = 16
#: Rows of a document in the model: counted and kept for learning weights, or only scored.
RETAINED, DELETED, SCORED = 0, 1, 2
#: Buckets of a context's frequency: 0, 1, 2-3, 4-7, ... occurrences; first those of one word, then those of two.
BUCKETS = 24
#: Log-ratio grid on which held-out tokens are counted for the fit, in steps of 1/GRID of e.
GRID, _ZERO = 2, 64

_END = mix(np.array([0xE0D], U64))
_START = mix(np.array([0x57A], U64))
_STEP = U64(0xD1342543DE82EF95)


def _tokens(table_text, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams of each order that end at each token (words, then one end per text), and its text."""
    data, offsets = text_bytes(table_text)
    words, docs = [], []
    for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
        part = data[offsets[i] : offsets[j]]
        starts, ends, doc = word_spans(part, offsets[i : j + 1] - offsets[i])
        words.append(span_hashes(part, starts, ends, fold=True))
        docs.append(doc + i)
    n = len(offsets) - 1
    word = np.concatenate([*words, np.repeat(_END, n)])
    doc = np.concatenate([*docs, np.arange(n)])
    order = np.argsort(doc, kind="stable")
    word, doc = word[order], doc[order]
    first = np.searchsorted(doc, np.arange(n))
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[first] = _START[0]
    earlier = np.empty_like(word)
    earlier[1:] = before[:-1]
    earlier[first] = _START[0]
    cut = ~U64((1 << (64 - bits)) - 1)
    pair = mix(before * _STEP + word)
    return [word, pair & cut, mix((mix(earlier) + before) * _STEP + word) & cut], doc


def _contexts(doc: np.ndarray) -> np.ndarray:
    """Index of each token's predecessor, -1 for a text's first."""
    at = np.arange(len(doc)) - 1
    at[np.r_[True, doc[1:] != doc[:-1]]] = -1
    return at


def pack_counts(counts: np.ndarray) -> bytes:
    """One byte a count; those of 255 or more follow in eight bytes each. Most are small, so they deflate well."""
    large = counts >= 255
    return zlib.compress(np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<u8").tobytes(), 1)


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    data = zlib.decompress(data)
    out = np.frombuffer(data, np.uint8, count=n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<u8", offset=n).astype(np.int64)
    return out


def held_out_cells(p3, p2, p1, p0, bucket) -> np.ndarray:
    """Grid cells (bucket and the logs of p3, p2, p1 over p0, a byte each; 0 for no probability) of held-out tokens."""
    code = bucket.astype(np.int64)
    for p in (p3, p2, p1):
        level = np.clip(np.rint(GRID * np.log(np.maximum(p, 1e-300) / p0)) + _ZERO, 1, 255).astype(np.int64)
        code = code << 8 | np.where(p > 0, level, 0)
    return code


def fit_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Mixture weights (trigram, bigram, unigram, uniform) of each bucket, by expectation-maximisation.

    A bucket without held-out tokens takes the weights of the one below it.
    """
    weights = np.full((2 * BUCKETS, 4), 1 / 4)
    bucket = cells >> 24
    parts = [cells >> 16 & 255, cells >> 8 & 255, cells & 255]
    p = np.stack([*(np.where(x > 0, np.exp((x - float(_ZERO)) / GRID), 0.0) for x in parts), np.ones(len(cells))], axis=1)
    for k in range(2 * BUCKETS):
        # Without a context of two words, or of one, those estimates are nil.
        may = np.array([k >= BUCKETS, k > 0, True, True], np.float64)
        own = bucket == k
        if not own.any():
            weights[k] = may / may.sum() if k in (0, 1, BUCKETS) else weights[k - 1]
            continue
        q, n, w = p[own], counts[own].astype(np.float64), may / may.sum()
        for _ in range(rounds):
            share = q * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) + 1e-3 * may
            w /= w.sum()
        weights[k] = w
    return weights


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(np.log2(context + 1.0)).astype(np.int64), BUCKETS - 1)


def _counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's weights."""
    if not len(keys) or weights.max() == 1:
        keys, counts = np.unique(keys, return_counts=True)
        return keys, counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(weights, first)


def _once(docs: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``copies`` and ``twin``: rows whose equal copies hold more than ``most`` bytes stand there once.

    ``twin`` tells such rows with one id apart (by a digest of the text and the part) and is null for all others. The
    second table has (doc_id, twin) of every copy; it is None where no row is that common.
    """
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    sizes = docs.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text") + F.lit(1)).alias("bytes"))
    # A written table has a size that Spark knows, so joining it shuffles no texts unless it is large.
    common = materialise(sizes.filter((F.col("n") > 1) & (F.col("bytes") > most)).select("row"), "common")
    alone = lambda df: df.select("doc_id", "text", "part", F.lit(1).cast("long").alias("copies"), F.lit(None).cast("string").alias("twin"))
    if common.isEmpty():
        discard(common)
        return alone(docs), None
    copies = docs.join(common, "row", "left_semi").select("doc_id", "text", "part")
    twin = F.concat(F.sha2("text", 256), F.col("part").cast("string")).alias("twin")
    once = copies.groupBy("doc_id", "text", "part").agg(F.count(F.lit(1)).alias("copies")).select("*", twin)
    return alone(docs.join(common, "row", "left_anti")).unionByName(once), copies.select("doc_id", twin)


def _part_of(fold, scored_fold: int, deleted_fold: int):
    return F.when(fold == scored_fold, SCORED).when(fold == deleted_fold, DELETED).otherwise(RETAINED)


SENT = "block int, bucket int, part int, keys binary, counts binary"
TOTALS = "block int, bucket int, part int, kept binary, every binary, size array<long>"


def score(docs: DataFrame, fold, folds: int = 7, scored_fold: int = 2, deleted_fold: int = 3, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Log10 probability of every whole text under an interpolated trigram model.

    ``fold`` is a column expression that gives each document a fold from 0 to
    ``folds`` - 1. Documents of ``scored_fold`` are scored only; all others are counted, and those
    of ``deleted_fold`` also fit the mixture weights. Tokens are the words, A-Z
    folded to a-z, and one end per text.

    Returns doc_id, held_out, n_tokens, n_known (tokens seen in training), train_tokens,
    base_score (add-one unigrams) and score. Null and empty texts have the end token alone. A
    null id counts as fold 0. Rows that share an id are separate documents. Other columns are
    ignored. An empty table gives an empty result. Counts are of all documents, without cut-offs.
    Equal rows (id and text) that would overfill a block are counted and scored once, with their number.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(fold, F.lit(0)).alias("fold"))
    n_rows, n_bytes = corpus_size(docs, "text")
    n_blocks = pieces(n_bytes + n_rows, block_bytes, spread=64)
    bits = min(64, max(32, SPARE_BITS + (n_bytes // 4 + n_rows + 1).bit_length()))
    # Blocks hold documents of one part only, so that learning weights reads the deleted part alone.
    docs = docs.select("doc_id", "text", _part_of(F.col("fold"), scored_fold, deleted_fold).alias("part"))
    docs, every_copy = _once(docs, (n_bytes + n_rows) // n_blocks)
    docs = docs.withColumn("block", (F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)) * 3 + F.col("part")).cast("int")).drop("part")
    shift = [U64(0), U64(64 - bits), U64(64 - bits)]

    def send(table: pa.Table) -> pa.Table:
        block, out = table["block"][0].as_py(), {"bucket": [], "part": [], "keys": [], "counts": []}
        orders, doc = _tokens(table["text"], bits)
        weights = table["copies"].to_numpy()[doc]
        for part, grams in enumerate(orders):
            keys, counts = _counted(grams, weights)
            for b, s in bucket_slices(keys, n_blocks):
                out["bucket"].append(b)
                out["part"].append(part)
                out["keys"].append(pack_sorted(keys[s] >> shift[part]))
                out["counts"].append(b"" if block % 3 == SCORED else pack_counts(counts[s]))
        n = len(out["bucket"])
        return pa.table({"block": pa.array([block] * n, pa.int32()), "bucket": pa.array(out["bucket"], pa.int32()), "part": pa.array(out["part"], pa.int32()), "keys": pa.array(out["keys"], pa.binary()), "counts": pa.array(out["counts"], pa.binary())})

    def total(table: pa.Table) -> pa.Table:
        out, size = {"block": [], "part": [], "kept": [], "every": []}, [0] * 4
        bucket = table["bucket"][0].as_py()
        for part in range(ORDERS):
            rows = table.filter(pc.equal(table["part"], part))
            blocks = rows["block"].to_pylist()
            if not blocks:
                continue
            parts = [unpack_sorted(x) for x in rows["keys"].to_pylist()]
            counts = [np.zeros(len(p), np.int64) if b % 3 == SCORED else unpack_counts(c, len(p)) for b, p, c in zip(blocks, parts, rows["counts"].to_pylist())]
            order = np.argsort(flat := np.concatenate(parts), kind="stable")
            new = np.r_[True, flat[order][1:] != flat[order][:-1]]
            which = np.empty(len(flat), np.int64)
            which[order] = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            every = np.add.reduceat(np.concatenate(counts)[order], first)
            kept = np.add.reduceat(np.concatenate([c if b % 3 == RETAINED else np.zeros(len(c), np.int64) for b, c in zip(blocks, counts)])[order], first)
            if part == 0:
                size = [int(every.sum()), int((every > 0).sum()), int(kept.sum()), int((kept > 0).sum())]
            for b, w in zip(blocks, np.split(which, np.cumsum([len(p) for p in parts])[:-1])):
                out["block"].append(b)
                out["part"].append(part)
                out["kept"].append(pack_counts(kept[w]) if b % 3 == DELETED else None)
                out["every"].append(pack_counts(every[w]))
        n = len(out["block"])
        return pa.table({
            "block": pa.array([*out["block"], -1], pa.int32()), "bucket": pa.array([bucket] * n + [-1], pa.int32()), "part": pa.array([*out["part"], -1], pa.int32()),
            "kept": pa.array([*out["kept"], None], pa.binary()), "every": pa.array([*out["every"], None], pa.binary()), "size": pa.array([None] * n + [size], pa.list_(pa.int64())),
        })

    sent = docs.groupBy("block").applyInArrow(send, SENT)
    answers = materialise(sent.groupBy("bucket").applyInArrow(total, TOTALS), "ngrams")
    sums = answers.filter("block = -1").agg(*[F.sum(F.col("size")[k]).alias(f"s{k}") for k in range(4)]).first()
    n_all, v_all, n_kept, v_kept = (int(x or 0) for x in sums)
    answers = answers.filter("block >= 0")

    def estimates(table: pa.Table, got: pa.Table, column: str, total: int, distinct: int):
        """Per token: its text, known count, the four estimates and the context's bucket."""
        orders, doc = _tokens(table["text"], bits)
        found = {(p, b): x for p, b, x in zip(got["part"].to_pylist(), got["bucket"].to_pylist(), got[column].to_pylist())}
        counts = []
        for part, grams in enumerate(orders):
            keys, which = np.unique(grams, return_inverse=True)
            own = np.zeros(len(keys), np.int64)
            for b, s in bucket_slices(keys, n_blocks):
                own[s] = unpack_counts(found[part, b], s.stop - s.start)
            if part == 0:
                # A text's start occurs once per training text, as its end does.
                texts = own[np.searchsorted(keys, _END[0])] if len(keys) else 0
            counts.append(own[which].astype(np.float64))
        one, two, three = counts
        at = _contexts(doc)
        near, far = np.where(at < 0, texts, one[np.maximum(at, 0)]), np.where(at < 0, texts, two[np.maximum(at, 0)])
        bucket = np.where(far > 0, BUCKETS + _bucket(far), _bucket(near))
        p3, p2 = np.where(far > 0, three / np.maximum(far, 1), 0.0), np.where(near > 0, two / np.maximum(near, 1), 0.0)
        return doc, one, p3, p2, one / max(total, 1), 1.0 / (distinct + 1), bucket

    def held(table: pa.Table, got: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        doc, _, p3, p2, p1, p0, bucket = estimates(table, got, "kept", n_kept, v_kept)
        cells, n = _counted(held_out_cells(p3, p2, p1, p0, bucket), table["copies"].to_numpy()[doc])
        return pa.table({"cell": pa.array(cells), "n": pa.array(n, pa.int64())})

    deleted = F.col("block") % 3 == DELETED
    grid = docs.filter(deleted).groupBy("block").cogroup(answers.filter(deleted).select("block", "bucket", "part", "kept").groupBy("block")).applyInArrow(held, "cell long, n long")
    rows = grid.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # bounded by the grid
    weights = fit_weights(rows["cell"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))

    def final(table: pa.Table, got: pa.Table) -> pa.Table:
        n = table.num_rows
        if not n:
            doc, known, tokens, base, model, block = np.zeros(0, np.int64), *(np.zeros(0) for _ in range(4)), SCORED
        else:
            block = table["block"][0].as_py()
            doc, one, p3, p2, p1, p0, bucket = estimates(table, got, "every", n_all, v_all)
            w = weights[bucket]
            p = w[:, 0] * p3 + w[:, 1] * p2 + w[:, 2] * p1 + w[:, 3] * p0
            tokens, known = np.bincount(doc, minlength=n), np.bincount(doc, one > 0, n)
            base = np.bincount(doc, np.log10((one + 1) / (n_all + v_all + 1)), n)
            model = np.bincount(doc, np.log10(p), n)
        return pa.table({
            "doc_id": table["doc_id"], "held_out": pa.array([block % 3 == SCORED] * n, pa.bool_()), "n_tokens": pa.array(tokens.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
            "train_tokens": pa.array([n_all] * n, pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(model, pa.float64()), "twin": table["twin"],
        })

    both = docs.groupBy("block").cogroup(answers.select("block", "bucket", "part", "every").groupBy("block"))
    scores = both.applyInArrow(final, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, twin string")
    if every_copy is None:
        return scores.drop("twin")
    scores = materialise(scores, "scores")
    names = [c for c in scores.columns if c != "twin"]
    shared = materialise(scores.filter("twin is not null"), "shared").alias("s")
    same = [F.col("c.doc_id").eqNullSafe(F.col("s.doc_id")), F.col("c.twin") == F.col("s.twin")]
    copies = every_copy.alias("c").join(shared, same).select(*(F.col(f"s.{c}") for c in names))
    return scores.filter("twin is null").select(*names).unionByName(copies)
