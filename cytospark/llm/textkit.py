"""Vectorised words and word n-gram hashes over Arrow text columns.

Texts are read straight from Arrow buffers as bytes. A word is a maximal run of
bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
Word hashes scramble eight bytes at a time, so that no arrangement of letters cancels out;
long words get a cryptographic hash. Windows of words have polynomial (Rabin-Karp)
hashes modulo 2**64 of these, taken from prefix sums. No Python string is made per word.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Words hashed at a time in windows: the tables of powers that each worker keeps are no longer than twice this.
SEGMENT = 1 << 16
#: Longer words are hashed one by one.
LONGEST_LANES = 64
_LANE_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _heap_trimmer():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return lambda pad: 0


def trim() -> None:
    """Give the heap that a worker process no longer uses back to the system, where the C library can."""
    _heap_trimmer()(0)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, with a ``trim`` after each, so that a waiting worker holds little memory."""
    for batch in batches:
        yield batch
        del batch
        trim()


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(SEGMENT.bit_length(), int(size).bit_length())
    return _powers(base, size), _powers(pow(base, -1, 1 << 64), size)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of its text; ``between`` says which bytes are in no word."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = ~between[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, doc


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1, fold: bool = False) -> np.ndarray:
    """64-bit hash of each byte span; ``fold`` treats A-Z as a-z.

    Unlike spans of equal length up to 8 bytes have unlike hashes.
    """
    if not len(starts):
        return np.zeros(0, U64)
    if fold:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    length = ends - starts
    out = mix(length.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
    live, at = np.flatnonzero((length > 0) & (length <= LONGEST_LANES)), 0
    while len(live):
        rest = length[live] - at
        out[live] = mix(out[live] ^ (lanes[starts[live] + at] & _LANE_MASK[np.minimum(rest, 8)]))
        live, at = live[rest > 8], at + 8
    for i in np.flatnonzero(length > LONGEST_LANES):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``n`` word hashes, by prefix sums modulo 2**64."""
    if len(words) < n:
        return np.zeros(0, U64)
    out = np.empty(len(words) - n + 1, dtype=U64)
    step = SEGMENT
    for i in range(0, len(out), step):
        part = words[i : min(i + step, len(out)) + n - 1]
        up, down = _power_tables(0xD1342543DE82EF95, len(part))
        sums = np.empty(len(part) + 1, dtype=U64)
        sums[0] = 0
        np.cumsum(part * up[: len(part)], out=sums[1:])
        k = len(part) - n + 1
        out[i : i + k] = mix((sums[n:] - sums[:-n]) * down[:k])
    return out


def batches_of_bytes(offsets: np.ndarray, limit: int):
    """Row ranges whose texts hold about ``limit`` bytes; one longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
