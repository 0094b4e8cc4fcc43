"""Quality scores: random Fourier features, ridge regression and isotonic calibration.

Document statistics are standardised and mapped to random Fourier features, whose inner
products approximate a Gaussian kernel. Each task adds up its part of the normal
equations; the driver solves the one small system, and calibrates the raw scores by
isotonic regression on a fold that the regression has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from ..scratch import discard, materialise
from .textkit import batches_of_bytes, span_hashes, text_bytes, trimmed, word_spans

CHUNK_BYTES = 1 << 20
FOURIER = 256
#: Width of the Gaussian kernel in units of root-mean-square distance, and ridge penalty.
WIDTH, RIDGE = 1.0, 1e-3
#: Cells into which raw scores are counted for calibration.
CELLS = 2000

_MARKS = b".,!?;:|-'\"#$%&*@()[]{}<>/\\+=_~^`"
STATISTICS = 16 + len(_MARKS)


def document_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text: sizes, shares of character classes, repetition, entropy."""
    rows = [np.zeros((0, STATISTICS))]
    for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
        part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        n, size = j - i, np.diff(own)
        count = np.zeros((n, 256))
        for a, b in batches_of_bytes(own, 1 << 18):
            doc = np.repeat(np.arange(b - a), size[a:b])
            count[a:b] = np.bincount(doc * 256 + part[own[a] : own[b]], minlength=(b - a) * 256).reshape(-1, 256)
        share = count / np.maximum(size, 1)[:, None]
        starts, ends, doc = word_spans(part, own)
        words = np.bincount(doc, minlength=n)
        length = (ends - starts).astype(np.float64)
        mean = np.bincount(doc, length, n) / np.maximum(words, 1)
        spread = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / np.maximum(words, 1) - mean**2, 0))
        key = span_hashes(part, starts, ends, fold=True) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        first = np.unique(key, return_index=True)[1]
        distinct = np.bincount(doc[first], minlength=n) / np.maximum(words, 1)
        ended = np.bincount(doc, ~np.isin(part[ends - 1], _LETTERS), n) / np.maximum(words, 1) if len(ends) else np.zeros(n)
        opened = np.bincount(doc, (part[starts] >= 65) & (part[starts] <= 90), n) / np.maximum(words, 1) if len(starts) else np.zeros(n)
        short = np.bincount(doc, length <= 3, n) / np.maximum(words, 1)
        entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(axis=1)
        table = [
            np.log1p(size), np.log1p(words), mean, spread, distinct, ended, opened, short, entropy,
            share[:, 97:123].sum(axis=1), share[:, 65:91].sum(axis=1), share[:, 48:58].sum(axis=1), share[:, 32], share[:, 10] * 10,
            share[:, 128:].sum(axis=1), share[:, :32].sum(axis=1) - share[:, 10],
        ]
        rows.append(np.column_stack([*table, *(np.sqrt(share[:, m]) for m in _MARKS)]))
    return np.concatenate(rows)


_LETTERS = np.array([*range(65, 91), *range(97, 123), *range(128, 256)], np.uint8)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of documents, each with the statistics of its whole texts; null texts count as empty."""
    for batch in trimmed(batches):
        yield batch, document_statistics(*text_bytes(batch.column("text"))).astype(np.float32)


def statistics_table(docs: DataFrame, others: str) -> DataFrame:
    """``docs`` with the statistics ``x`` in place of ``text``; ``others`` names its remaining columns and their types."""
    names = [field.split()[0] for field in others.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _statistics(batches):
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * STATISTICS, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in names}, "x": column})

    return docs.select("text", *names).mapInArrow(run, f"{others}, x array<float>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    level: np.ndarray
    chance: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.column_stack([np.ones(len(z)), z, np.cos(z @ self.frequency + self.phase)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.level, self.chance)


def isotonic(level: np.ndarray, positive: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing fit of positive / total by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for p, t in zip(positive, total):
        blocks.append([p, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            p2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + p2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), p / t) for p, t, n in blocks]) if blocks else np.zeros(0)


def _matrix(batch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().astype(np.float64).reshape(-1, STATISTICS)


def fit(labelled: DataFrame, calibration_fold: int = 4, seed: int = 8) -> Model:
    """Fit on (fold, x, y): all rows but those of ``calibration_fold``, which calibrate.

    Every labelled row takes part. Without labels the score is 0.5; without rows in either part,
    the other serves for both.
    """
    folds = {r["fold"] == calibration_fold for r in labelled.groupBy("fold").count().collect()}
    fitting = labelled.filter(F.col("fold") != calibration_fold) if False in folds else labelled
    checking = labelled.filter(F.col("fold") == calibration_fold) if True in folds else labelled
    sums = [f(F.col("x")[i].cast("double")) for f in (F.avg, F.stddev_pop) for i in range(STATISTICS)]
    moments = np.array([0.0 if v is None else v for v in fitting.agg(*sums).first()]).reshape(2, -1)
    rng = np.random.default_rng(seed)
    frequency = rng.normal(size=(STATISTICS, FOURIER)) / (WIDTH * np.sqrt(2 * STATISTICS))
    base = Model(moments[0], np.maximum(moments[1], 1e-3), frequency, rng.uniform(0, 2 * np.pi, FOURIER), np.zeros(1 + STATISTICS + FOURIER), np.zeros(1), np.full(1, 0.5))
    size = len(base.weight)
    if not folds:
        return base

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            phi = base.features(_matrix(batch))
            total[:, :size] += phi.T @ phi
            total[:, size] += phi.T @ batch.column("y").to_numpy()
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * (size + 1))
        for batch in batches:
            for x in batch.column("total"):
                total += np.frombuffer(x.as_buffer())
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    parts = fitting.select("x", "y").mapInArrow(add, "total binary").repartition(8).mapInArrow(merge, "total binary").collect()
    total = sum(np.frombuffer(r["total"]) for r in parts).reshape(size, size + 1)
    n = max(total[0, 0], 1.0)
    weight = np.linalg.solve(total[:, :size] / n + RIDGE * np.eye(size), total[:, size] / n)
    model = Model(base.mean, base.scale, frequency, base.phase, weight, base.level, base.chance)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.clip(np.rint(model.raw(_matrix(batch)) * CELLS / 2), -CELLS, 2 * CELLS).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(cell), "y": batch.column("y")})

    cells = checking.select("x", "y").mapInArrow(count, "cell long, y double").groupBy("cell").agg(F.sum("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    cells = sorted((r["cell"], r["p"], r["n"]) for r in cells)
    level = np.array([c[0] for c in cells]) * 2 / CELLS
    chance = isotonic(level, np.array([c[1] for c in cells]), np.array([c[2] for c in cells]))
    return Model(base.mean, base.scale, frequency, base.phase, weight, level, np.clip(chance, 0.0, 1.0))


def quality_scores(docs: DataFrame, labels: DataFrame, fold, held_out_fold: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score) of every row of ``docs``: the chance that its label is 1.

    Labels of documents in ``held_out_fold`` are not used. Rows of ``labels`` with a null
    id or label are left out; where an id has several labels their mean counts. Null,
    empty and very long texts are scored by the same statistics. Null ids count as fold 0.
    Other columns are ignored, but for those in ``carry``, which follow the result's.
    Empty tables give an empty result.
    """
    extra = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(fold, F.lit(0)).cast("int").alias("fold"), *(F.col(c).alias(x) for c, x in zip(carry, extra)))
    result = StructType([*StructType.fromDDL("doc_id long, held_out boolean, score double").fields, *(StructField(x, docs.schema[x].dataType, True) for x in extra)])
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).dropna().groupBy("doc_id").agg(F.avg("y").alias("y"))
    # Statistics are taken anew for the scores: writing them for all documents would cost more.
    labelled = docs.filter(F.col("fold") != held_out_fold).select("doc_id", "fold", "text")
    labelled = materialise(statistics_table(labelled, "doc_id long, fold int").join(known, "doc_id").select("fold", "x", "y"), "labelled")
    model = fit(labelled)
    discard(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _statistics(batches):
            held = np.asarray(batch.column("fold").to_numpy()) == held_out_fold
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": pa.array(held), "score": pa.array(model.score(x.astype(np.float64))), **{c: batch.column(c) for c in extra}})

    return docs.mapInArrow(run, result).withColumnsRenamed(dict(zip(extra, carry)))
