"""Vector bin packing of examples into fixed-length training sequences.

Three limits hold at once for a sequence: tokens, segments and loss-bearing tokens. The
dot-product heuristic fills a sequence with the example whose need is best aligned with
what is left of the three; where nothing fits whole, an example is cut to fill the gap.
Examples are packed within batches of bounded bytes, so no task sees more than one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .textkit import batches_of_bytes, text_bytes, trimmed
from .tokenise import UnitEncoder

BATCH_BYTES = 4 << 20

#: With a column of first loss-bearing tokens, ``n_loss`` follows.
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """Most tokens, segments and loss-bearing tokens of one sequence."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


def _longest(start: int, tokens: int, free: int, loss_from: int, loss: int) -> int:
    """Tokens from ``start`` on that fit ``free`` tokens and ``loss`` loss-bearing ones."""
    return min(tokens - start, free, max(0, loss_from - start) + loss)


class _Needs:
    """Open examples by what they need: equal needs share a row, so a choice looks at the distinct ones."""

    def __init__(self, cap: np.ndarray):
        self.cap, self.rows = cap, 0
        self.need, self.share = np.zeros((64, 3)), np.zeros((64, 3))
        self.open = np.zeros(64, bool)
        self.held: list[list[int]] = []
        self.row_of: dict[tuple[int, int], int] = {}

    def add(self, example: int, tokens: int, loss: int) -> None:
        k = self.row_of.get((tokens, loss))
        if k is None:
            if self.rows == len(self.need):
                self._close_up()
            k = self.row_of[tokens, loss] = self.rows
            if k == len(self.need):
                self.need, self.share, self.open = (np.concatenate([x, np.zeros_like(x)]) for x in (self.need, self.share, self.open))
            self.need[k] = tokens, 1, loss
            self.share[k] = self.need[k] / self.cap
            self.held.append([])
            self.rows += 1
        self.held[k].append(example)
        self.open[k] = True

    def _close_up(self) -> None:
        """Drop the rows of needs that no example has any more."""
        keep = np.flatnonzero(self.open[: self.rows])
        if 2 * len(keep) > self.rows:
            return
        for x in (self.need, self.share, self.open):
            x[: len(keep)] = x[keep]
        self.open[len(keep) :] = False
        self.held = [self.held[k] for k in keep]
        self.rows = len(keep)
        self.row_of = {(int(n[0]), int(n[2])): k for k, n in enumerate(self.need[: self.rows])}

    def _take(self, k: int) -> int:
        example = self.held[k].pop()
        self.open[k] = bool(self.held[k])
        return example

    def remove(self, example: int, tokens: int, loss: int) -> None:
        k = self.row_of[tokens, loss]
        self.held[k].remove(example)
        self.open[k] = bool(self.held[k])

    def best(self, room: np.ndarray) -> int | None:
        """The example that fits whole and is best aligned with ``room``, by dot product."""
        n = self.rows
        fits = self.open[:n] & (self.need[:n] <= room).all(axis=1)
        if not fits.any():
            return None
        return self._take(int(np.argmax(np.where(fits, self.share[:n] @ (room / self.cap), -1.0))))

    def longest(self) -> int:
        return self._take(int(np.argmax(np.where(self.open[: self.rows], self.need[: self.rows, 0], -1.0))))


def pack(tokens: np.ndarray, loss_from: np.ndarray, limits: Limits = Limits()) -> np.ndarray:
    """Pieces (example, start, length, sequence, offset) that hold every token once.

    Tokens of an example from position ``loss_from`` on bear loss. Sequences that the
    limits on segments or loss close early, and those of what is left in the end, are cut
    at a power of two, which needs no padding; an example without tokens has no piece.
    """
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    start = np.zeros(len(tokens), np.int64)
    # Parts that fill a sequence by themselves.
    for i in np.flatnonzero(tokens >= min(limits.tokens, limits.loss)):
        n, lf = int(tokens[i]), int(loss_from[i])
        while True:
            take = _longest(int(start[i]), n, limits.tokens, lf, limits.loss)
            if take < limits.tokens:
                break
            out.append((int(i), int(start[i]), take, sequence, 0))
            start[i] += take
            sequence += 1
            if start[i] >= n:
                break
    cap = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
    needs = _Needs(cap)

    def _left(i: int) -> tuple[int, int]:
        return int(tokens[i] - start[i]), int(max(0, tokens[i] - max(start[i], loss_from[i])))

    def put_back(i: int) -> None:
        if start[i] < tokens[i]:
            needs.add(i, *_left(i))

    for i in np.flatnonzero(tokens > start):
        put_back(int(i))
    remaining = int((tokens - start).sum())
    while remaining:
        room = cap.copy()
        if remaining < limits.tokens:
            room[0] = 1 << (remaining.bit_length() - 1)
        here: list[tuple[int, int]] = []
        while room[0] > 0 and room[1] > 0 and remaining:
            i = needs.best(room)
            if i is None:
                i = needs.longest()
            take = _longest(int(start[i]), int(tokens[i]), int(room[0]), int(loss_from[i]), int(room[2]))
            if take <= 0:
                put_back(i)
                break
            lost = max(0, int(start[i]) + take - max(int(start[i]), int(loss_from[i])))
            here.append((i, take))
            start[i] += take
            remaining -= take
            room -= (take, 1, lost)
            put_back(i)
        used = sum(t for _, t in here)
        over = 0 if used == limits.tokens else used - (1 << (used.bit_length() - 1))
        undone: set[int] = set()
        while over:
            i, take = here.pop()
            if i not in undone and start[i] < tokens[i]:
                needs.remove(i, *_left(i))
            undone.add(i)
            back = min(take, over)
            if take > back:
                here.append((i, take - back))
            over, remaining = over - back, remaining + back
            start[i] -= back
        for i in sorted(undone):
            put_back(i)
        begin: dict[int, int] = {}
        for i, take in here:
            begin[i] = begin.get(i, int(start[i])) - take
        offset = 0
        for i, take in here:
            out.append((i, begin[i], take, sequence, offset))
            begin[i] += take
            offset += take
        sequence += 1
    return np.array(out, np.int64).reshape(-1, 5)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, loss_from_col: str | None = None) -> DataFrame:
    """Tokenise whole texts, append ``end_id`` and pack; one row per piece.

    A piece is ``length`` tokens of its document from ``start`` on, at ``offset`` of
    sequence ``sequence_id``; ``ids`` holds them as little-endian unsigned 32-bit integers.
    All tokens bear loss, or with ``loss_from_col`` those from that token of the text on
    (null or negative: all; past the end: none), the end id like any other; the last
    ``n_loss`` tokens of a piece are the ones that do. Null and empty texts have the end id alone. Null ids are kept as
    such; rows that share an id are packed as separate documents. Other columns are
    ignored; an empty table gives no piece.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError(f"limits must be 1 or more: {limits}")
    loss_from = F.lit(0) if loss_from_col is None else F.coalesce(F.col(loss_from_col), F.lit(0))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), loss_from.cast("long").alias("loss_from"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = UnitEncoder(tokenizer)
        sequence = (TaskContext.get().partitionId() + 1) << 36
        for batch in trimmed(batches):
            ids_of = batch.column("doc_id")
            data, offsets = text_bytes(batch.column("text"))
            for i, j in batches_of_bytes(offsets, batch_bytes):
                ids, ends = bpe.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                ids = np.insert(ids, ends, end_id).astype("<u4")
                ends = ends + np.arange(1, len(ends) + 1)
                first = np.r_[0, ends[:-1]]
                tokens = ends - first
                bears = np.clip(batch.column("loss_from").to_numpy()[i:j], 0, tokens)
                piece = pack(tokens, bears, limits)
                at = first[piece[:, 0]] + piece[:, 1]
                n_loss = np.minimum(piece[:, 2], np.maximum(0, piece[:, 1] + piece[:, 2] - bears[piece[:, 0]]))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids_of.slice(i, j - i).take(pa.array(piece[:, 0])),
                    "start": pa.array(piece[:, 1]), "length": pa.array(piece[:, 2]),
                    "ids": pa.array([ids[a : a + n].tobytes() for a, n in zip(at.tolist(), piece[:, 2].tolist())], pa.binary()),
                    "doc_tokens": pa.array(tokens[piece[:, 0]]), "sequence_id": pa.array(piece[:, 3] + sequence), "offset": pa.array(piece[:, 4]),
                    **({"n_loss": pa.array(n_loss)} if loss_from_col is not None else {}),
                })
                sequence += int(piece[:, 3].max()) + 1 if len(piece) else 0

    return docs.mapInArrow(run, PIECES if loss_from_col is None else PIECES + ", n_loss long")
