"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are rounded down to whole numbers, so that scores are exact and ties are real. The
top of the tree is a set of pivots chosen farthest first from a bounded sample; every vector
hangs below its nearest pivot. What hangs below one pivot is cut into blocks by row, and each block
gets a cover tree of its own: the children of a node are farther apart than the
radius by which they cover its points. Queries are indexed the same way.

A search takes a query tree and a block's tree together: a pair of nodes is dropped when
even the best that their radii allow is less than the worst k-th score of the queries in the query
node. Query groups first visit the pivots that look best to them, which gives
them a k-th score to prune the others with.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..scratch import materialise

#: Children of a node, points of a leaf, levels at most (then what is left is cut by position).
FAN, LEAF, DEPTH = 16, 32, 24
#: Rows in the sample that pivots come from, vectors a pivot stands for and pivots at most.
SAMPLE_ROWS, PER_PIVOT, MOST_PIVOTS = 4096, 4096, 1024
#: Vectors of a block (and how many blocks there are at least where there are rows for them), queries of a group and of a task.
BLOCK_ROWS, LEAST_ROWS, SPREAD, GROUP_ROWS, TASK_QUERIES = 65536, 512, 48, 4096, 65536
#: Share of all vectors that a query group visits first, by the pivots that look best.
FIRST_SHARE = 1 / 16
#: Products up to this are exact as doubles.
EXACT = float(1 << 53)
FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def farthest_first(x: np.ndarray, most: int, least: float = 0.0) -> tuple[list[int], np.ndarray, np.ndarray, float]:
    """Up to ``most`` points, each the farthest from those before; every point's nearest of them, how far that is, and the largest of it.

    It stops when all points are within ``least`` of a chosen one.
    """
    chosen, owner = [0], np.zeros(len(x), np.int64)
    away = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < most:
        i = int(away.argmax())
        if away[i] <= least * least or away[i] <= 0:
            break
        d = ((x - x[i]) ** 2).sum(axis=1)
        nearer = d < away
        owner[nearer], away[nearer] = len(chosen), d[nearer]
        chosen.append(i)
    return chosen, owner, np.sqrt(away), float(np.sqrt(away.max()))


class CoverTree:
    """Points in the order of the leaves, and nodes in breadth-first order.

    A node has a centre (one of its points), the radius that covers its points, its range of points, and its range of
    children (empty for a leaf).
    """

    def __init__(self, x: np.ndarray, row: np.ndarray, ident: np.ndarray):
        order, nodes, i = np.arange(len(x)), [[0, 0, len(x), 0, 0]], 0
        levels, radii = [0], []
        z = x.astype(np.float64)
        while i < len(nodes):
            centre, lo, hi, _, _ = nodes[i]
            own = order[lo:hi]
            d = np.sqrt(((z[own] - z[centre]) ** 2).sum(axis=1))
            radii.append(float(d.max(initial=0.0)))
            if hi - lo > LEAF and radii[-1] > 0:
                nodes[i][3] = len(nodes)
                if levels[i] < DEPTH:
                    # The node's centre comes first and is its own child.
                    own = np.r_[own[own == centre], own[own != centre]]
                    chosen, part, _, _ = farthest_first(z[own], FAN, radii[-1] / 2)
                    sort = np.argsort(part, kind="stable")
                    order[lo:hi] = own[sort]
                    ends = lo + np.cumsum(np.bincount(part, minlength=len(chosen)))
                    kids = [(int(own[c]), int(a), int(b)) for c, a, b in zip(chosen, np.r_[lo, ends[:-1]], ends)]
                else:
                    kids = [(int(order[a]), a, min(hi, a + LEAF)) for a in range(lo, hi, LEAF)]
                for c, a, b in kids:
                    nodes.append([c, a, b, 0, 0])
                    levels.append(levels[i] + 1)
                nodes[i][4] = len(nodes)
            i += 1
        table = np.array(nodes, np.int64).reshape(-1, 5)
        self.x, self.row, self.ident = x[order], row[order], ident[order]
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        self.centre = place[table[:, 0]] if len(x) else table[:, 0]
        self.lo, self.hi, self.first, self.last = table[:, 1], table[:, 2], table[:, 3], table[:, 4]
        # Rounding of the distances must not make a radius too small.
        self.radius = np.array(radii) * (1 + 1e-12)

    FIELDS = ("x", "row", "ident", "centre", "lo", "hi", "first", "last", "radius")

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> CoverTree:
        self = cls.__new__(cls)
        with np.load(io.BytesIO(data), allow_pickle=False) as z:
            for f in cls.FIELDS:
                setattr(self, f, z[f])
        return self


class Search:
    """One query tree against one data tree; ``least`` is a score of each query that its k-th best is known to reach."""

    def __init__(self, queries: CoverTree, data: CoverTree, k: int, least: np.ndarray):
        self.q, self.d, self.k = queries, data, k
        exact = np.abs(queries.x).max(initial=0) * float(np.abs(data.x).max(initial=0)) * max(1, data.x.shape[1]) < EXACT
        kind = np.float64 if exact else np.int64
        self.qx, self.dx = queries.x.astype(kind), data.x.astype(kind)
        self.qc, self.dc = (t.x[t.centre].astype(np.float64) for t in (queries, data))
        self.qn, self.dn = (np.sqrt((c * c).sum(axis=1)) for c in (self.qc, self.dc))
        self.least = least.astype(np.float64)
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3 for _ in range(len(queries.x))]
        if len(queries.x) and len(data.x):
            self._visit(0, np.zeros(1, np.int64))

    def _bounds(self, a: int, nodes: np.ndarray) -> np.ndarray:
        """No query below ``a`` scores more with a point below each of ``nodes``."""
        r, s = self.q.radius[a], self.d.radius[nodes]
        top = self.dc[nodes] @ self.qc[a] + r * self.dn[nodes] + s * self.qn[a] + r * s
        return top + 1e-9 * (np.abs(top) + (self.qn[a] + r) * (self.dn[nodes] + s)) + 1e-6

    def _worst(self, a: int) -> float:
        """The least k-th score of the queries below ``a``."""
        return float(self.least[self.q.lo[a] : self.q.hi[a]].min())

    def _visit(self, a: int, nodes: np.ndarray) -> None:
        """Go down both trees; ``nodes`` are the data nodes that the queries below ``a`` may still need."""
        leaf = self.q.first[a] == self.q.last[a]
        while True:
            bound = self._bounds(a, nodes)
            keep = bound >= self._worst(a)
            nodes, bound = nodes[keep], bound[keep]
            if not len(nodes):
                return
            inner = self.d.first[nodes] < self.d.last[nodes]
            if not inner.any():
                break
            opened = nodes[inner]
            size = self.d.last[opened] - self.d.first[opened]
            kids = np.repeat(self.d.first[opened] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            nodes = np.r_[nodes[~inner], kids]
            if not leaf:
                bound = self._bounds(a, nodes)
                nodes = nodes[bound >= self._worst(a)]
                break
        if not leaf:
            # Queries whose bound is best go first within each node, so later ones prune with what is known.
            for child in range(self.q.first[a], self.q.last[a]):
                self._visit(child, nodes)
            return
        order = np.argsort(-bound, kind="stable")
        nodes, bound = nodes[order], bound[order]
        i = 0
        while i < len(nodes) and bound[i] >= self._worst(a):
            j = min(len(nodes), i + 64)
            j = i + max(1, int((bound[i:j] >= self._worst(a)).sum()))
            self._score(a, nodes[i:j])
            i = j

    def _score(self, a: int, leaves: np.ndarray) -> None:
        size = self.d.hi[leaves] - self.d.lo[leaves]
        at = np.repeat(self.d.lo[leaves] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        lo, hi = self.q.lo[a], self.q.hi[a]
        scores = self.qx[lo:hi] @ self.dx[at].T
        good = (scores >= self.least[lo:hi, None]) & (self.q.row[lo:hi, None] != self.d.row[at][None, :])
        for i in np.flatnonzero(good.any(axis=1)):
            new = np.flatnonzero(good[i])
            if len(new) > 4 * self.k:
                new = new[scores[i, new] >= np.partition(scores[i, new], -self.k)[-self.k]]
            score, ident, row = self.best[lo + i]
            score = np.r_[score, scores[i, new].astype(np.int64)]
            ident, row = np.r_[ident, self.d.ident[at[new]]], np.r_[row, self.d.row[at[new]]]
            first = np.lexsort((row, ident, -score))[: self.k]
            self.best[lo + i] = score[first], ident[first], row[first]
            if len(first) == self.k:
                self.least[lo + i] = max(self.least[lo + i], float(score[first[-1]]))

    def found(self) -> pa.RecordBatch:
        n = np.array([len(b[0]) for b in self.best], np.int64)
        score, ident, row = (np.concatenate([b[i] for b in self.best] or [np.zeros(0, np.int64)]) for i in range(3))
        return pa.RecordBatch.from_pydict({"query_row": np.repeat(self.q.row, n), "query_id": np.repeat(self.q.ident, n), "row": row, "vec_id": ident, "score": score})


def without_copies(x: np.ndarray, ident: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Positions of the vectors, less those that ``most`` equal ones with smaller ids stand before."""
    order = np.lexsort((row, ident, *x.T))
    z = x[order]
    new = np.r_[True, (z[1:] != z[:-1]).any(axis=1)] if len(z) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    place = np.arange(len(z)) - np.repeat(start, np.diff(np.r_[start, len(z)]))
    return np.sort(order[place < most])


def _matrix(column, dim: int) -> np.ndarray:
    """Whole vectors of a column, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(flat) == len(column) * dim:
        return flat.reshape(-1, dim)
    out = np.zeros((len(column), dim), np.int64)
    row = np.repeat(np.arange(len(column)), length)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the exact ``k`` best of all other rows for each row that ``is_query`` holds for.

    Components x become floor(scale * x); the score is the inner product of those, ties
    go to the smaller id. Rows without an id, and vectors that are null or hold null or non-finite
    components, take no part. Vectors of unequal length are compared over the components
    that both have. Only the query's own row is no candidate: rows that repeat an
    id are candidates for each other, and each that is a query has ranks of its own. Zero and empty vectors score 0.
    With fewer than ``k`` other rows all of them are given. Other columns are ignored; an empty table gives an empty result.
    Raises where the components are so large that scores could leave 64 bits.
    """
    spark = vectors.sparkSession
    x = F.col(vector_col)
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fine = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) * scale < 2.0**62))
    huge = x.isNotNull() & F.exists(x, lambda v: v.isNotNull() & (F.abs(v.cast("double")) * scale >= 2.0**62) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"), fine.alias("fine"), huge.alias("huge"))
    size = F.when(F.col("fine"), F.size("x"))
    largest = F.when(F.col("fine"), F.greatest(F.array_max("x"), -F.array_min("x")))
    seen = rows.agg(F.count_if("fine").alias("n"), F.max(size).alias("dim"), F.max(largest).alias("largest"), F.count_if("huge").alias("huge")).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if seen["huge"] or int(seen["largest"] or 0) ** 2 * int(seen["dim"] or 0) >= 1 << 62:
        raise ArithmeticError("inner products of these vectors could leave 64 bits")
    if not seen["n"]:
        return spark.createDataFrame([], schema)
    total, dim = int(seen["n"]), int(seen["dim"])
    rows = rows.filter("fine").select("vec_id", "x", "asks")

    sample = rows.orderBy(F.xxhash64("vec_id", "x"), "vec_id").limit(SAMPLE_ROWS).select("x").toArrow()
    points = _matrix(sample["x"], dim).astype(np.float64)
    pivots = points[farthest_first(points, min(MOST_PIVOTS, max(1, total // PER_PIVOT)))[0]]

    def hang(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector below its nearest pivot."""
        own = (pivots * pivots).sum(axis=1)
        for batch in batches:
            z = _matrix(batch.column("x"), dim).astype(np.float64)
            cell = np.concatenate([np.argmin(own - 2 * z[i : i + 4096] @ pivots.T, axis=1) for i in range(0, len(z), 4096)] or [np.zeros(0, np.int64)])
            away = np.sqrt(((z - pivots[cell]) ** 2).sum(axis=1)) * (1 + 1e-12)
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("row", "vec_id", "x", "asks")}, "cell": pa.array(cell.astype(np.int32)), "away": pa.array(away)})

    rows = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(hang, "row long, vec_id long, x array<long>, asks boolean, cell int, away double")
    rows = materialise(rows, "indexed")
    cells = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asks"), F.max("away").alias("away")).collect()  # at most one row a pivot
    size = min(BLOCK_ROWS, max(LEAST_ROWS, total // SPREAD))
    radius, held = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    blocks, groups = np.zeros(len(pivots), np.int64), np.zeros(len(pivots), np.int64)
    for r in cells:
        radius[r["cell"]], held[r["cell"]] = r["away"], r["n"]
        blocks[r["cell"]], groups[r["cell"]] = -(-r["n"] // size), -(-r["asks"] // GROUP_ROWS)
    first = np.cumsum(blocks) - blocks
    asked = sum(r["asks"] for r in cells)
    if not asked:
        return spark.createDataFrame([], schema)
    chunks, n_groups = -(-asked // TASK_QUERIES), int(groups.sum())

    def part(counts: np.ndarray) -> Column:
        """The block or group of a row: those of its pivot, by a hash of the row."""
        start, parts = (F.split(F.lit(" ".join(map(str, v))), " ").cast("array<int>") for v in (np.cumsum(counts) - counts, np.maximum(counts, 1)))
        cell = F.col("cell") + 1
        return F.element_at(start, cell) + F.pmod(F.xxhash64("row"), F.element_at(parts, cell)).cast("int")

    def grow(table: pa.Table, copies: int | None = None) -> CoverTree:
        table = table.sort_by("row")
        x, row, ident = _matrix(table["x"], dim), table["row"].to_numpy(), table["vec_id"].to_numpy()
        at = slice(None) if copies is None else without_copies(x, ident, row, copies)
        return CoverTree(x[at], row[at], ident[at])

    def index(table: pa.Table) -> pa.Table:
        # Of equal vectors, those with the k + 1 smallest ids leave no room for others in any list.
        return pa.table({"block": table["block"][:1], "tree": pa.array([grow(table, k + 1).pack()], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        """A query group's tree, and the pivots by the best that they can hold for it."""
        tree = grow(table)
        centre, r = tree.x[tree.centre[0]].astype(np.float64), tree.radius[0]
        value = pivots @ centre
        most = value + r * np.sqrt((pivots * pivots).sum(axis=1)) + radius * np.sqrt((centre * centre).sum()) + r * radius
        most = most + 1e-9 * (np.abs(most) + 1) + 1e-6
        order = np.argsort(-value, kind="stable")
        order = order[held[order] > 0]
        near = int(np.searchsorted(np.cumsum(held[order]), max(k + 1, total * FIRST_SHARE))) + 1
        group = table["group"][0].as_py()
        to = [{"cell": int(c), "most": float(most[c]), "early": i < near} for i, c in enumerate(order)]
        kind = pa.list_(pa.struct([("cell", pa.int32()), ("most", pa.float64()), ("early", pa.bool_())]))
        return pa.table({"group": table["group"][:1], "chunk": pa.array([group * chunks // n_groups], pa.int32()), "tree": pa.array([tree.pack()], pa.binary()), "to": pa.array([to], kind)})

    trees = materialise(rows.withColumn("block", part(blocks)).select("block", "row", "vec_id", "x").groupBy("block").applyInArrow(index, "block int, tree binary"), "trees")
    queries = rows.filter("asks").withColumn("group", part(groups)).select("group", "row", "vec_id", "x")
    queries = materialise(queries.groupBy("group").applyInArrow(gather, "group int, chunk int, tree binary, to array<struct<cell:int,most:double,early:boolean>>"), "queries")

    def search(wanted: pa.Table, blocks_: pa.Table) -> pa.Table:
        out = []
        if wanted.num_rows and blocks_.num_rows:
            data = CoverTree.unpack(blocks_["tree"][0].as_py())
            for tree, rows_, least in zip(wanted["tree"], wanted["rows"], wanted["least"]):
                q = CoverTree.unpack(tree.as_py())
                known = np.full(len(q.row), -np.inf)
                if rows_.is_valid and len(rows_):
                    sort = np.argsort(q.row)
                    known[sort[np.searchsorted(q.row[sort], rows_.values.to_numpy())]] = least.values.to_numpy()
                out.append(Search(q, data, k, known).found())
        return pa.Table.from_batches(out, schema=_ARROW_FOUND)

    at = F.split(F.lit(" ".join(map(str, first))), " ").cast("array<int>")
    many = F.split(F.lit(" ".join(map(str, blocks))), " ").cast("array<int>")

    def visit(groups_: DataFrame) -> DataFrame:
        """Scores of query groups in all blocks of the pivots that they go to; a block is copied to every chunk of queries."""
        cell = F.col("cell") + 1
        sent = groups_.withColumn("block", F.explode(F.sequence(F.element_at(at, cell), F.element_at(at, cell) + F.element_at(many, cell) - 1)))
        stored = trees.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        return sent.select("block", "chunk", "tree", "rows", "least").groupBy("block", "chunk").cogroup(stored.groupBy("block", "chunk")).applyInArrow(search, FOUND)

    best = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    nothing = (F.lit(None).cast("array<long>").alias("rows"), F.lit(None).cast("array<long>").alias("least"))
    early = materialise(visit(queries.select("chunk", "tree", F.inline("to")).filter("early").select("chunk", "tree", "cell", *nothing)), "found")
    # The k-th score of each query so far, gathered for its group; queries with fewer have none.
    kth = early.withColumn("rank", best).filter(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("least"))
    home = rows.filter("asks").select("row", part(groups).alias("group"))
    known = home.join(kth, "row", "left").groupBy("group").agg(
        F.collect_list(F.when(F.col("least").isNotNull(), F.col("row"))).alias("rows"), F.collect_list("least").alias("least"), F.min(F.coalesce("least", F.lit(-(1 << 63)))).alias("worst")
    )
    # Trees are copied to their pivots after the join, and are never sent through the driver: Spark, which knows their size as it is on disk, would broadcast them.
    late = queries.hint("merge").join(known, "group").select("chunk", "tree", "rows", "least", "worst", F.inline("to")).filter("not early and most >= worst")
    found = early.unionByName(visit(late.select("chunk", "tree", "cell", "rows", "least")))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_ARROW_FOUND = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "row", "vec_id", "score")])
