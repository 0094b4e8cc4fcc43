"""Near-duplicate documents by SetSketch registers, banding, joint estimation and exact checks.

1. Every document's set of word shingles becomes a SetSketch: register ``r`` holds
   floor(log_base(scale / x)), x the least point that any shingle's Poisson process puts
   on ``r``. Processes are cut off where a register is filled with near certainty, in
   layers that all documents share, so work per document is about n + m log m.
2. Documents with equal sets form a class; one representative goes on.
3. Bands of registers are bucket keys. Inside buckets, pairs are compared by the joint
   likelihood of (less, equal, greater) registers and both set sizes; implausible pairs
   fall away, and the others' connected components are families of candidates.
4. Families are compared on full sets, and links found give the components.

A hot bucket or family is cut into blocks. Each block compares its own members with one
another and with a few representatives of the whole; members that this joins to the
first representative are joined to each other, and only the rest is compared with all
blocks. So a group of near copies costs time in proportion to its size, and no pair is
left out but those whose documents are in one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import StructField, StructType

from .components import connected_components, local_components
from ..scratch import discard, materialise
from .textkit import U64, batches_of_bytes, mix, span_hashes, text_bytes, trim, trimmed, window_hashes, word_spans

BANDS, ROWS = 48, 5
REGISTERS = BANDS * ROWS
#: Base of the registers' logarithm: one byte covers sets of 1 to some 10**8 shingles.
BASE = 1.09
SCALE = 20.0
#: Natural-log likelihood by which a pair may fall short of the threshold and yet be checked.
SLACK = 16.0
#: Members of a bucket, and text bytes of a family, that are compared in one piece.
BUCKET_BLOCK = 1024
FAMILY_BYTES = 1 << 20
#: Representatives of a hot bucket, of a large family.
BUCKET_HEADS, FAMILY_HEADS = 16, 4
CHUNK_BYTES = 2 << 20

#: Layers of the Poisson processes: the first ends at 2**-8, each other doubles the end.
_ENDS = [2.0**k for k in range(-8, 5)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, words folded to lower case (A-Z).

    A text with fewer words than ``size`` has its whole word sequence as one shingle;
    a text without words has none.
    """
    sets: list[np.ndarray] = []
    for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
        part = data[offsets[i] : offsets[j]]
        starts, ends, doc = word_spans(part, offsets[i : j + 1] - offsets[i])
        words = span_hashes(part, starts, ends, fold=True)
        grams = window_hashes(words, size)
        first = np.searchsorted(doc, np.arange(j - i + 1))
        for k in range(j - i):
            a, b = first[k], first[k + 1]
            if b - a >= size:
                sets.append(np.unique(grams[a : b - size + 1]))
            elif b > a:
                sets.append(window_hashes(words[a:b], int(b - a)) + U64(b - a))
            else:
                sets.append(words[:0])
    return sets


@lru_cache(maxsize=None)
def _poisson(layer: int) -> np.ndarray:
    """Cumulative probabilities of the number of points that a layer holds."""
    mean = REGISTERS * (_ENDS[layer] - (_ENDS[layer - 1] if layer else 0.0))
    k = np.arange(int(mean + 12 * mean**0.5 + 25))
    logs = np.cumsum(np.log(np.maximum(k, 1)))
    return np.cumsum(np.exp(k * np.log(mean) - mean - logs))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers, one row of bytes per set; an empty set has zeros."""
    sizes = np.array([len(s) for s in sets])
    least = np.full(len(sets) * REGISTERS, np.inf)
    if sizes.sum():
        need = (np.log(REGISTERS) + 7.0) / np.maximum(sizes, 1)
        last = np.minimum(np.searchsorted(_ENDS, need), len(_ENDS) - 1)
        for layer in range(int(last.max()) + 1):
            rows = np.flatnonzero((last >= layer) & (sizes > 0))
            if not len(rows):
                break
            shingles = np.concatenate([sets[r] for r in rows])
            doc = np.repeat(rows, sizes[rows])
            draw = mix(shingles ^ mix(np.array([layer + 1], U64)))
            count = np.searchsorted(_poisson(layer), _unit(draw))
            has = np.flatnonzero(count)
            count = count[has]
            at = np.repeat(draw[has], count)
            step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            point = mix(at + (step + 1).astype(U64) * U64(0x9E3779B97F4A7C15))
            low = _ENDS[layer - 1] if layer else 0.0
            x = low + (_ENDS[layer] - low) * _unit(point)
            register = ((mix(point) >> U64(32)) * U64(REGISTERS)) >> U64(32)
            np.minimum.at(least, np.repeat(doc[has], count) * REGISTERS + register.astype(np.int64), x)
    level = np.floor((np.log(SCALE) - np.log(least)) / np.log(BASE))
    return np.clip(np.where(np.isfinite(least), level, 0), 0, 255).astype(np.uint8).reshape(-1, REGISTERS)


def _log_p(x: np.ndarray) -> np.ndarray:
    """log of p_b(x) = -log_b(1 - x (b - 1) / b), the chance that one register exceeds the other."""
    return np.log(np.maximum(-np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12))


def joint_log_likelihood(similarity, n1, n2, less, equal, greater):
    """Log-likelihood of a Jaccard similarity given set sizes and register comparisons."""
    u = n1 / (n1 + n2)
    v = 1.0 - u
    g, s = _log_p(u - v * similarity), _log_p(v - u * similarity)
    e = np.log(np.maximum(1.0 - np.exp(g) - np.exp(s), 1e-12))
    return greater * g + less * s + equal * e


def plausible(n1, n2, less, equal, greater, threshold: float) -> np.ndarray:
    """Whether a similarity of ``threshold`` or more is within SLACK of the most likely one."""
    most = np.minimum(n1 / n2, n2 / n1)
    at = joint_log_likelihood(np.minimum(threshold, most), n1, n2, less, equal, greater)
    lo, hi = np.zeros_like(most), most.copy()
    for _ in range(25):
        a, b = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        rises = joint_log_likelihood(a, n1, n2, less, equal, greater) < joint_log_likelihood(b, n1, n2, less, equal, greater)
        lo, hi = np.where(rises, a, lo), np.where(rises, hi, b)
    likely = (lo + hi) / 2
    best = joint_log_likelihood(likely, n1, n2, less, equal, greater)
    return (most >= threshold) & ((likely >= threshold) | (best - at <= SLACK))


def _signatures(batches: Iterator[pa.RecordBatch], size: int, extra: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in trimmed(batches):
        data, offsets = text_bytes(batch.column("text"))
        for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
            sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").slice(i, j - i),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "bytes": pa.array(np.diff(offsets[i : j + 1]), pa.int64()),
                "class": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "sketch": pa.array([r.tobytes() for r in sketches(sets)], pa.binary()),
                **{c: batch.column(c).slice(i, j - i) for c in extra},
            })


def _with_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, BANDS, ROWS)
        code = np.zeros(rows.shape[:2], U64)
        for k in range(ROWS):
            code = (code << U64(8)) | rows[:, :, k].astype(U64)
        code = mix(mix(code) + np.arange(1, BANDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)).view(np.int64)
        keys = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, BANDS), pa.int32()), pa.array(code.ravel()))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "keys": keys})


def _group_pairs(bounds: np.ndarray, side: np.ndarray, inner: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of each group; in groups that have a side 1, only those across, unless ``inner``."""
    sizes = np.diff(bounds)
    two = (np.add.reduceat(side, bounds[:-1]) > 0) & (not inner)
    for s in np.unique(sizes[~two & (sizes > 1)]):
        at = bounds[:-1][(sizes == s) & ~two]
        a, b = np.triu_indices(int(s), 1)
        step = max(1, 200_000 // len(a))
        for k in range(0, len(at), step):
            base = at[k : k + step, None]
            yield (base + a).ravel(), (base + b).ravel()
    for g in np.flatnonzero(two):
        rows = np.arange(bounds[g], bounds[g + 1])
        left, right = rows[side[rows] == 0], rows[side[rows] == 1]
        yield np.repeat(left, len(right)), np.tile(right, len(left))


def _unsettled(bounds: np.ndarray, ids: np.ndarray, side: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Rows of side 0, in groups with representatives (side 1), that are not joined to the least of those."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    heads = np.flatnonzero(side == 1)
    heads = heads[np.lexsort((ids[heads], group[heads]))]
    main = np.full(len(bounds) - 1, -1)
    main[group[heads][::-1]] = root[heads[::-1]]
    return np.flatnonzero((side == 0) & (main[group] >= 0) & (root != main[group]))


LINKS = "a long, b long, grp long"


def _link_rows(ids: np.ndarray, root: np.ndarray, rest: np.ndarray, owner: np.ndarray) -> dict[str, pa.Array]:
    """(a, b) from each row to its root, then (a, null, bucket or family) of the unsettled ``rest``."""
    child = np.flatnonzero(root != np.arange(len(ids)))
    return {
        "a": pa.array(np.r_[ids[child], ids[rest]], pa.int64()),
        "b": pa.array(np.r_[ids[root[child]], np.zeros(len(rest), np.int64)], pa.int64(), mask=np.r_[np.zeros(len(child), bool), np.ones(len(rest), bool)]),
        "grp": pa.array(np.r_[np.zeros(len(child), np.int64), owner[rest]], pa.int64()),
    }


def _bucket_links(batches: Iterator[pa.RecordBatch], threshold: float, inner: bool) -> Iterator[pa.RecordBatch]:
    """Spanning links of plausible pairs, from rows that are sorted by group; with ``inner`` also who is unsettled."""

    def links(table: pa.Table) -> pa.RecordBatch:
        group = table["grp"].to_numpy()
        bounds = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)]
        ids, n, side = table["doc_id"].to_numpy(), table["n"].to_numpy().astype(np.float64), table["side"].to_numpy()
        rows = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, REGISTERS)
        got_a, got_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in _group_pairs(bounds, side, inner):
            for k in range(0, len(a), 100_000):
                x, y = a[k : k + 100_000], b[k : k + 100_000]
                fit = np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y])
                x, y = x[fit], y[fit]
                equal = (rows[x] == rows[y]).sum(axis=1)
                near = (equal >= REGISTERS * (threshold - 0.3)) | (ids[x] == ids[y])
                x, y, equal = x[near], y[near], equal[near].astype(np.float64)
                greater = (rows[x] > rows[y]).sum(axis=1).astype(np.float64)
                keep = plausible(n[x], n[y], REGISTERS - equal - greater, equal, greater, threshold) | (ids[x] == ids[y])
                got_a.append(x[keep])
                got_b.append(y[keep])
        root = local_components(len(ids), np.concatenate(got_a), np.concatenate(got_b))
        rest = _unsettled(bounds, ids, side, root) if inner else np.zeros(0, np.int64)
        return pa.RecordBatch.from_pydict(_link_rows(ids, root, rest, table["key"].to_numpy()))

    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        group = table["grp"].to_numpy()
        cut = int(np.searchsorted(group, group[-1])) if len(group) else 0
        if cut:
            yield links(table.slice(0, cut))
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield links(rest)


def exact_links(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) with 100 * intersection >= percent * union, by postings of shared shingles."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if sets else np.zeros(0, U64)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    ends = np.r_[start[1:], len(ranked)]
    code = np.empty(len(flat), np.int64)
    code[order] = np.cumsum(new) - 1
    posted = owner[order]
    first = np.r_[0, np.cumsum(sizes)]
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(len(sets)):
        own = code[first[d] : first[d + 1]]
        own = own[ends[own] - start[own] > 1]
        if not len(own):
            continue
        length = ends[own] - start[own]
        at = np.arange(length.sum()) + np.repeat(start[own] - (np.cumsum(length) - length), length)
        shared = np.bincount(posted[at], minlength=len(sets))
        hit = np.flatnonzero(100 * shared >= percent * (sizes[d] + sizes - shared))
        hit = hit[(hit > d) & (sizes[hit] > 0)]
        out_a.append(np.full(len(hit), d))
        out_b.append(hit)
    return np.concatenate(out_a), np.concatenate(out_b)


def _in_blocks(members: DataFrame, heads: int) -> DataFrame:
    """(doc_id, key, grp, side) from (doc_id, key, blocks): a group a block, with the representatives of keys of several."""
    own = F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")
    plain = members.select("doc_id", "key", own.alias("block"), F.lit(0).alias("side"))
    if heads:
        some = members.filter("blocks > 1").groupBy("key", "blocks", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(heads)).alias("s")).agg(F.min("doc_id").alias("doc_id"))
        some = some.select("doc_id", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"))
        plain = plain.unionByName(some)
    return plain.select("doc_id", "key", F.xxhash64("key", "block").alias("grp"), "side")


def _rest_in_blocks(rest: DataFrame, members: DataFrame, size: str | None, most: int) -> DataFrame:
    """The unsettled members of each key, in chunks (side 1), with every block of that key (side 0)."""
    sums = rest.groupBy("key").agg(F.ceil((F.sum(size) if size else F.count(F.lit(1))) / F.lit(most)).cast("int").alias("chunks"))
    both = members.join(sums, "key")
    left = both.withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = rest.join(sums, "key").withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(3)), "chunks").cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = lambda d, side: d.select("doc_id", "key", F.xxhash64("key", "block", "chunk").alias("grp"), F.lit(side).alias("side"))
    return keyed(left, 0).unionByName(keyed(right, 1))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 75, carry: tuple[str, ...] = ()) -> DataFrame:
    """Documents linked at a Jaccard similarity of ``percent`` % of their shingle sets.

    Returns, for each row of ``docs``: doc_id, n_shingles, component_id (the least doc_id
    that links reach) and kept (whether the document is that one). Links are confirmed on
    full sets. Documents whose sets are equal need not be compared.

    Null, empty or blank texts have empty sets and link with nothing. A null id gives a
    row of its own with a null component, kept. Rows that repeat an id are one node: each
    gets a row, with the same component (those without words have their id). Other columns are ignored, whatever their names,
    but for those in ``carry``, which follow the result's. An empty table gives
    an empty result. Texts of any length are taken whole.
    """
    threshold = percent / 100
    extra = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(x) for c, x in zip(carry, extra)))
    schema = StructType([*StructType.fromDDL("doc_id long, n long, bytes long, class binary, sketch binary").fields, *(StructField(x, docs.schema[x].dataType, True) for x in extra)])
    sig = materialise(docs.mapInArrow(lambda it: _signatures(it, shingle, extra), schema), "signatures")
    full = sig.filter("n > 0 and doc_id is not null")
    heads = full.groupBy("class").agg(F.min(F.struct("doc_id", "n", "bytes", "sketch")).alias("it")).select("class", "it.*")
    # A digest says whether an id has texts of several classes.
    several = full.groupBy("doc_id").agg(F.min(F.xxhash64("class")).alias("lo"), F.max(F.xxhash64("class")).alias("hi")).filter("lo < hi").select("doc_id")
    heads = materialise(heads, "heads")

    keys = heads.select("doc_id", "sketch").mapInArrow(_with_bands, "doc_id long, keys array<long>").select("doc_id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    seen = Observation()
    members = keys.join(shared, "key").select("doc_id", "key", F.ceil(F.col("members") / F.lit(BUCKET_BLOCK)).cast("int").alias("blocks"))
    members = materialise(members, "members", seen, F.max("blocks").alias("most"))
    hot = (seen.get["most"] or 0) > 1

    def compared(rows: DataFrame, inner: bool) -> DataFrame:
        rows = rows.join(heads.select("doc_id", "n", "sketch"), "doc_id").repartition("grp").sortWithinPartitions("grp")
        return rows.mapInArrow(lambda it: _bucket_links(it, threshold, inner), LINKS)

    links, seen_links = compared(_in_blocks(members, BUCKET_HEADS if hot else 0), inner=True), None
    if hot:
        links = seen_links = materialise(links, "links")
        rest = links.filter("b is null").select(F.col("a").alias("doc_id"), F.col("grp").alias("key")).distinct()
        rest = rest.join(members.filter("blocks > 1"), ["doc_id", "key"])
        links = links.filter("b is not null").unionByName(compared(_rest_in_blocks(rest, members.filter("blocks > 1"), None, BUCKET_BLOCK), inner=False))
    families = connected_components(links.filter("b is not null"))
    grouped = families.join(heads.select(F.col("doc_id").alias("node"), "bytes"), "node")
    totals = grouped.groupBy("component").agg(F.sum("bytes").alias("total"))
    seen = Observation()
    grouped = grouped.join(totals, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("key"), "bytes", F.ceil(F.col("total") / F.lit(FAMILY_BYTES)).cast("int").alias("blocks"))
    grouped = materialise(grouped.withColumn("blocks", F.greatest(F.lit(1), "blocks")), "families", seen, F.max("blocks").alias("most"))
    large = (seen.get["most"] or 0) > 1

    # Texts of candidates alone, dealt out once; the same plan at every size.
    texts = materialise(docs.select("doc_id", "text").join(grouped.select("doc_id").distinct().hint("merge"), "doc_id"), "texts")

    def confirm(table: pa.Table, inner: bool) -> pa.Table:
        trim()
        table = table.sort_by([("side", "ascending"), ("doc_id", "ascending")])
        data, offsets = text_bytes(table["text"])
        a, b = exact_links(shingle_sets(data, offsets, shingle), percent)
        ids, side = table["doc_id"].to_numpy(), table["side"].to_numpy()
        # Rows of one document (a representative in its own block) are one.
        order = np.argsort(ids, kind="stable")
        same = np.flatnonzero(ids[order][1:] == ids[order][:-1])
        root = local_components(len(ids), np.r_[a, order[same]], np.r_[b, order[same + 1]])
        rest = _unsettled(np.array([0, len(ids)]), ids, side, root) if inner else np.zeros(0, np.int64)
        return pa.table(_link_rows(ids, root, rest, table["key"].to_numpy()))

    def checked(rows: DataFrame, inner: bool) -> DataFrame:
        rows = texts.join(rows, "doc_id").select("grp", "key", "doc_id", "side", "text")
        return rows.groupBy("grp").applyInArrow(lambda t: confirm(t, inner), LINKS)

    found, tried = checked(_in_blocks(grouped, FAMILY_HEADS if large else 0), inner=True), None
    if large:
        found = tried = materialise(found, "found")
        rest = found.filter("b is null").select(F.col("a").alias("doc_id"), F.col("grp").alias("key")).distinct().join(grouped, ["doc_id", "key"])
        found = found.filter("b is not null").unionByName(checked(_rest_in_blocks(rest, grouped.filter("blocks > 1"), "bytes", FAMILY_BYTES), inner=False))
    found = found.filter("b is not null").select("a", "b")
    # A class stands for all documents with its set; an id with several sets joins their classes.
    classes = heads.select("class", F.col("doc_id").alias("rep"))
    several = materialise(several, "several")
    if several.take(1):
        found = found.unionByName(full.join(several, "doc_id", "left_semi").join(classes, "class").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    component = connected_components(found).withColumnRenamed("node", "rep")
    discard(members, seen_links, families, grouped, texts, tried, several)
    classes = classes.join(component, "rep", "left").select("class", F.coalesce("component", "rep").alias("component_id"))
    own = sig.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class")).alias("class"), *extra)
    out = own.join(classes, "class", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *extra).withColumnsRenamed(dict(zip(extra, carry)))
