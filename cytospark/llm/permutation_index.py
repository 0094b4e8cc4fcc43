"""Nearest neighbours by inner product with a permutation index.

Vectors are represented by their nearest pivots, in order. Each vector is posted, with that
order, in the inverted files of its first few pivots. A query probes the files of its own
nearest pivots, ranks what it finds by footrule distance between the orders, and scores what
is near enough by the exact inner product.

The number of pivots follows the square root of the number of vectors. How many files are
probed, and how near an order must be, is set for each table by brute force on a few of
its queries: as little as finds TARGET of their true neighbours. So vectors that cluster are
searched in few files, and recall holds for those that do not.

Inner products become cosines by one more coordinate: with M the largest norm, vectors
get sqrt(M^2 - |x|^2) and queries 0, which keeps the order of inner products. Of equal
vectors only the k + 1 with the smallest ids can be among anyone's k nearest, and equal
queries are asked once, so a vector that is very common costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window as W, functions as F
from pyspark.sql.types import FloatType

from ..scratch import materialise

#: Pivots per square root of the number of vectors, and their least and greatest number (they are a sample).
PIVOTS, LEAST_PIVOTS, MOST_PIVOTS = 4, 64, 16384
#: Pivots in a vector's order, and files that it is posted in.
ORDER, POSTED = 32, 4
#: Queries that set the search up, share of their neighbours to find by files and of those by footrule, least number of files.
TRIALS, TARGET, LEAST_PROBED = 64, (0.97, 0.98), 64
#: Bytes, as they are compared, of a block's posted rows and of the queries that it meets in one task.
BLOCK_BYTES, QUERY_BYTES = 96 << 20, 48 << 20
#: At least SPREAD blocks where there are LEAST_ROWS rows for each.
LEAST_ROWS, SPREAD = 1024, 24
#: Rows whose components are flattened at a time.
CLEANED_ROWS = 1024


def _usable(ids: pa.Array, column: pa.Array, kind: str) -> pa.RecordBatch:
    """(id, dim, norm, vec) of the rows without nulls, non-finite components or zero norm, from the flattened components."""
    keep = pc.and_(ids.is_valid(), column.is_valid())
    ids, column = ids.filter(keep), column.filter(keep)
    flat, size = column.flatten(), np.asarray(pc.list_value_length(column), np.int64)
    x = np.asarray(pc.fill_null(flat.cast(pa.float64()), 0.0), np.float64)
    bad = np.asarray(pc.fill_null(flat.is_null(), False), bool) | ~np.isfinite(x)
    row = np.repeat(np.arange(len(size)), size)
    with np.errstate(over="ignore", invalid="ignore"):
        squares = np.bincount(row, x * x, len(size))
    good = (np.bincount(row, bad, len(size)) == 0) & (np.bincount(row, x != 0, len(size)) > 0)
    x, size = x[good[row]].astype(kind), size[good]
    ends = np.concatenate([[0], np.cumsum(size * x.itemsize)])
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(x.tobytes())])
    return pa.RecordBatch.from_pydict({"id": ids.filter(pa.array(good)).cast(pa.int64()), "dim": pa.array(size, pa.int32()), "norm": pa.array(np.sqrt(squares[good])), "vec": packed})


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """(id, dim, norm, vec): vectors that take part, as packed numbers of their own width."""
    kind = "<f4" if isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CLEANED_ROWS):
                part = batch.slice(i, CLEANED_ROWS)
                yield _usable(part.column(0), part.column(1), kind)

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, "id long, dim int, norm double, vec binary"), kind


def _matrix(column, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def nearest_pivots(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` nearest pivots of each row, nearest first, ties to the earlier pivot."""
    far = -(np.column_stack([x, extra]) @ pivots.T)
    if most < len(pivots):
        some = np.sort(np.argpartition(far, most - 1, axis=1)[:, :most], axis=1)
        order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
        return np.take_along_axis(some, order, 1).astype(np.uint16)
    return np.argsort(far, axis=1, kind="stable").astype(np.uint16)


def _closeness(order: int, pivots: int, own: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """``order``**2 less the footrule distance of ``orders`` to a query's: sums of order - |difference in place|."""
    table = np.zeros((order, pivots), np.int16)
    place = np.arange(min(order, len(own)))
    table[:, own[place]] = np.maximum(0, order - np.abs(np.arange(order)[:, None] - place[None, :]))
    out = np.zeros(len(orders), np.int32)
    for j in range(orders.shape[1]):
        out += table[j].take(orders[:, j])
    return out


def _trials(base: DataFrame, asked: list, k: int, kind: str, dim: int, orders) -> tuple[np.ndarray, np.ndarray]:
    """For the true neighbours of some queries: the files to probe until each is met, and its closeness."""
    queries = np.stack([np.frombuffer(r["vec"], kind) for r in asked]).astype(np.float64)
    own_ids = np.array([r["id"] for r in asked])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, scores, vecs = (np.zeros((len(queries), 0), t) for t in (np.int64, np.float64, object))
        for batch in batches:
            new = batch.column("id").to_numpy()
            score = queries @ _matrix(batch.column("vec"), kind, dim).T
            score[own_ids[:, None] == new[None, :]] = -np.inf
            scores = np.hstack([scores, score])
            ids = np.hstack([ids, np.broadcast_to(new, score.shape)])
            vecs = np.hstack([vecs, np.broadcast_to(np.array(batch.column("vec").to_pylist(), object), score.shape)])
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            ids, scores, vecs = (np.take_along_axis(x, top, 1) for x in (ids, scores, vecs))
        q = np.repeat(np.arange(len(queries)), ids.shape[1])
        yield pa.RecordBatch.from_pydict({"q": pa.array(q, pa.int32()), "id": pa.array(ids.ravel()), "score": pa.array(scores.ravel()), "vec": pa.array(vecs.ravel().tolist(), pa.binary())})

    found = base.select("id", "vec").mapInArrow(best, "q int, id long, score double, vec binary").filter(F.col("score") > float("-inf"))
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "id"))
    found = found.withColumn("r", rank).filter(F.col("r") <= k).select("q", "vec").collect()  # TRIALS * k rows at most
    if not found:
        return np.zeros(0), np.zeros(0)
    whole = orders(queries, query=True)
    theirs = orders(np.stack([np.frombuffer(r["vec"], kind) for r in found]).astype(np.float64), query=False)
    need, close = [], []
    for r, order in zip(found, theirs):
        own = whole[r["q"]]
        place = np.empty(len(own), np.int64)
        place[own] = np.arange(len(own))
        need.append(place[order[:POSTED]].min() + 1)
        close.append(_closeness(len(order), len(own), own, order[None, :])[0])
    return np.array(need), np.array(close)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows of ``vectors`` that were found.

    Score is the inner product in double precision; nearest first, ties to the smaller
    id. A row with the query's own id is no candidate. Vectors that are null, empty or
    zero or hold nulls or non-finite components take no part, nor do those whose length is
    not the commonest one (of equally common ones the smaller). Rows that repeat an id count once,
    with their best score. Other columns are ignored. Empty tables give an empty result.
    The pivots and the queries that set the search up are bounded samples; every vector is indexed.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    clean, kind = _clean(vectors, id_col, vector_col)
    base = materialise(clean, "vectors")
    shape = base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m")).orderBy(F.desc("n"), "dim").first()
    asked, asked_kind = _clean(queries, id_col, vector_col)
    if shape is None:
        return spark.createDataFrame([], schema)
    dim, top = int(shape["dim"]), float(shape["m"])
    copies = F.row_number().over(W.partitionBy("vec").orderBy("id"))
    seen = Observation()
    base = base.filter(F.col("dim") == dim).select("id", "vec").distinct().withColumn("copy", copies).filter(F.col("copy") <= k + 1)
    base = materialise(base, "vectors", seen, F.count(F.lit(1)).alias("n"))
    wide = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, round(PIVOTS * seen.get["n"] ** 0.5))))
    sample = base.filter("copy = 1").orderBy(F.xxhash64("vec"), "id").limit(wide).select("vec").collect()
    p = np.array([np.frombuffer(r["vec"], kind) for r in sample], np.float64) / top
    p = np.column_stack([p, np.sqrt(np.maximum(0.0, 1.0 - (p * p).sum(axis=1)))])
    wide, order, posted = len(p), min(ORDER, len(p)), min(POSTED, len(p))

    def orders(x: np.ndarray, query: bool, most: int | None = None) -> np.ndarray:
        x = x / top
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
        return nearest_pivots(x, extra, p, most or (wide if query else order))

    asked = materialise(asked.filter(F.col("dim") == dim).select("id", "vec").distinct(), "queries")
    distinct = asked.groupBy("vec").agg(F.min("id").alias("id"))
    trials = distinct.orderBy(F.xxhash64("id", F.lit(4)), "id").limit(TRIALS).collect()
    if not trials:
        return spark.createDataFrame([], schema)
    need, close = _trials(base, [{"id": r["id"], "vec": np.frombuffer(r["vec"], asked_kind).astype(kind).tobytes()} for r in trials], k, kind, dim, orders)
    probed, least = wide, 0
    if len(need):
        probed = int(min(wide, max(LEAST_PROBED, np.quantile(need, TARGET[0], method="higher"))))
        least = int(np.quantile(close[need <= probed], 1 - TARGET[1], method="lower"))
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = orders(_matrix(batch.column("vec"), kind, dim), query=False)
            row = np.repeat(np.arange(len(own)), posted)
            at = pa.array(row)
            yield pa.RecordBatch.from_pydict({
                "file": pa.array(own[:, :posted].ravel().astype(np.int32)), "id": batch.column("id").take(at), "vec": batch.column("vec").take(at),
                "near": pa.array([x.tobytes() for x in own], pa.binary()).take(at),
            })

    files = materialise(base.select("id", "vec").mapInArrow(post, "file int, id long, vec binary, near binary"), "files")
    sizes = {r["file"]: r["count"] for r in files.groupBy("file").count().collect()}  # at most one row a pivot
    # Small neighbouring files share a block; a large one is cut into several.
    rows, block, filled = [], 0, 0
    most = min(max(1, BLOCK_BYTES // (8 * dim + 2 * order)), max(LEAST_ROWS, sum(sizes.values()) // SPREAD))
    for f in sorted(sizes):
        parts = -(-sizes[f] // most)
        if parts > 1 or filled + sizes[f] > most:
            block, filled = block + (filled > 0), 0
        rows.append((f, block, parts))
        block, filled = (block + parts, 0) if parts > 1 else (block, filled + sizes[f])
    where = F.broadcast(spark.createDataFrame(rows, "file int, block int, parts int"))  # at most one row a pivot
    block_of, parts_of = (np.array([r[c] for r in rows], np.int64) for c in (1, 2))
    held_files = np.array([r[0] for r in rows], np.int64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with the start of its order, the set of its files a bit each, and the blocks that hold any."""
        for batch in batches:
            own = orders(_matrix(batch.column("vec"), asked_kind, dim), query=True, most=max(probed, order))
            probes = np.zeros((len(own), wide), bool)
            np.put_along_axis(probes, own[:, :probed].astype(np.int64), True, axis=1)
            blocks = []
            for mine in probes[:, held_files]:
                first, parts = block_of[mine], parts_of[mine]
                blocks.append(np.unique(np.repeat(first, parts) + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)).tolist())
            yield pa.RecordBatch.from_pydict({
                "query_id": batch.column("id"), "vec": batch.column("vec"), "near": pa.array([x.tobytes() for x in np.ascontiguousarray(own[:, :order])], pa.binary()),
                "probes": pa.array([x.tobytes() for x in np.packbits(probes, axis=1)], pa.binary()), "blocks": pa.array(blocks, pa.list_(pa.int32())),
            })

    sent = materialise(distinct.select("id", "vec").mapInArrow(ask, "query_id long, vec binary, near binary, probes binary, blocks array<int>"), "asked")
    # Queries that are too many for one task go to copies of the block.
    fit = max(1, QUERY_BYTES // (8 * dim + 2 * order + wide // 8))
    chunks = sent.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(fit)).cast("int").alias("chunks"))
    stored = files.join(where, "file").withColumn("block", F.col("block") + F.pmod(F.xxhash64("id"), "parts").cast("int")).join(chunks, "block")
    stored = stored.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("block", "chunk", "file", "id", "vec", "near")
    sent = sent.withColumn("block", F.explode("blocks")).drop("blocks").join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("query_id"), "chunks").cast("int")).drop("chunks")

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if rows.num_rows and wanted.num_rows:
            rows = rows.take(pc.sort_indices(rows, sort_keys=[("file", "ascending"), ("id", "ascending")]))
            ids, file, x = rows["id"].to_numpy(), rows["file"].to_numpy(), _matrix(rows["vec"], kind, dim)
            near = np.frombuffer(b"".join(rows["near"].to_pylist()), np.uint16).reshape(-1, order)
            held, begin = np.unique(file, return_index=True)
            end = np.r_[begin[1:], len(file)]
            asked_near = np.frombuffer(b"".join(wanted["near"].to_pylist()), np.uint16).reshape(-1, order)
            asked_files = np.frombuffer(b"".join(wanted["probes"].to_pylist()), np.uint8).reshape(len(asked_near), -1)
            # Which of its own files each row was posted in here.
            turn = (near[:, :posted] == file[:, None]).argmax(axis=1)
            for q, v, own, bits in zip(wanted["query_id"].to_numpy(), _matrix(wanted["vec"], asked_kind, dim), asked_near, asked_files):
                probes = np.unpackbits(bits, count=wide).view(bool)
                mine = np.flatnonzero(probes[held])
                if not len(mine):
                    continue
                at = np.concatenate([np.arange(begin[f], end[f]) for f in mine])
                # A vector counts in the nearest to it of those of its files which the query probes.
                at = at[probes[near[at, :posted]].argmax(axis=1) == turn[at]]
                close = _closeness(order, wide, own, near[at])
                good = close >= least
                if good.sum() <= k:
                    good = np.argsort(-close, kind="stable")[: k + 1]
                at = at[good]
                score = x[at] @ v
                best = np.lexsort((ids[at], -score))
                best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])[: k + 1]]
                out["query_id"].append(np.full(len(best), q))
                out["vec_id"].append(ids[at][best])
                out["score"].append((x[at[best]] * v).sum(axis=1))
        join = lambda c, t: pa.array(np.concatenate(out[c]) if out[c] else np.zeros(0), t)
        return pa.table({"query_id": join("query_id", pa.int64()), "vec_id": join("vec_id", pa.int64()), "score": join("score", pa.float64())})

    found = stored.groupBy("block", "chunk").cogroup(sent.groupBy("block", "chunk")).applyInArrow(search, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = lambda key: F.row_number().over(W.partitionBy(key).orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", best("query_id")).filter(F.col("rank") <= k + 1).withColumnRenamed("query_id", "rep").drop("rank")
    # Equal queries share what the one with the least id has found.
    mine = asked.join(distinct.select("vec", F.col("id").alias("rep")), "vec").select(F.col("id").alias("query_id"), "rep")
    found = mine.join(found, "rep").filter("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", best("query_id")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
