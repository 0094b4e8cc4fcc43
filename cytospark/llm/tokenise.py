"""Token ids of whole texts by a public BPE tokenizer, with each distinct unit encoded once.

A text is cut only where the tokenizer's own pre-tokenizer always cuts: before a single
space between visible characters, and between a letter and an ASCII punctuation mark
other than an apostrophe. Units between cuts are encoded by the tokenizers library and
remembered by a 64-bit hash, in flat arrays of bounded size, and
compared with its bytes when it is met again. A text in which a special token's string may occur,
or two units that share a hash, is encoded in one piece.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from .textkit import U64, batches_of_bytes, span_hashes

CHUNK_BYTES = 2 << 20
#: Units that are remembered at most, and bytes of them.
MOST_UNITS, MOST_BYTES = 1_000_000, 32 << 20
LONGEST_KEPT = 256

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK[48:58] = _MARK[65:91] = _MARK[97:123] = False
_MARK[39] = False
_SEEN = np.zeros(256, bool)
_SEEN[33:127] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each unit, and which bytes are letters (ASCII and Latin-1 ones)."""
    n = len(data)
    lead = data == 0xC3
    lead[-1] = False
    tail = np.zeros(n, bool)
    tail[1:] = lead[:-1]
    sign = tail & ((data == 0x97) | (data == 0xB7))
    latin = tail & ~sign
    letter = _LETTER[data] | latin
    letter[:-1] |= latin[1:]
    seen = _SEEN[data] | lead | tail
    mark = _MARK[data]
    cut = np.zeros(n + 1, bool)
    cut[1 : n - 1] = (data[1:-1] == 32) & seen[:-2] & seen[2:]
    cut[1:n] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    cut[offsets] = True
    return np.flatnonzero(cut[:n]), letter


class UnitEncoder:
    """Encodes batches of texts by a tokenizer file; its store is bounded in units and bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        size = max(vocabulary.values()) + 1
        #: Word-end vocabularies mark where a word ends; byte-level ones count its bytes.
        self.word_end = any(t.endswith("</w>") for t in vocabulary)
        self.closes, self.width = np.zeros(size + 2, bool), np.zeros(size + 2, np.int64)
        for token, i in vocabulary.items():
            self.closes[i] = token.endswith("</w>")
            self.width[i] = len(token)
        self.keys = np.zeros(0, U64)
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, bool)
        self.pool = np.zeros(0, np.uint32)
        #: The units' own bytes.
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.uint8)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of letter-only units that each start with a space, and how many each has."""
        joined = [b"".join(words[i : i + 500]).decode() for i in range(0, len(words), 500)]
        ids = np.concatenate(self._encode(joined))
        if self.word_end:
            ends = np.flatnonzero(self.closes[ids]) + 1
        else:
            at = np.cumsum(self.width[ids])
            ends = np.searchsorted(at, np.cumsum([len(w) for w in words])) + 1
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not end a token where a word ends")
        return ids, np.diff(ends, prepend=0)

    def _learn(self, keys: np.ndarray, units: list[bytes], plain: np.ndarray) -> None:
        flat = [i for i in range(len(units)) if plain[i]]
        other = [i for i in range(len(units)) if not plain[i]]
        length = np.zeros(len(units), np.int64)
        parts = []
        if flat:
            ids, count = self._encode_words([units[i] for i in flat])
            length[flat] = count
            parts.append(ids)
        if other:
            got = self._encode([units[i].decode() for i in other])
            length[other] = [len(g) for g in got]
            parts += got
        order = np.array(flat + other, np.int64)
        start = np.empty(len(units), np.int64)
        start[order] = len(self.pool) + np.cumsum(length[order]) - length[order]
        self.pool = np.concatenate([self.pool, *parts])
        size = np.array([len(u) for u in units], np.int64)
        begin = len(self.bytes) + np.cumsum(size) - size
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(units), np.uint8)])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.at, self.size = np.insert(self.at, at, begin), np.insert(self.size, at, size)
        self.start, self.length = np.insert(self.start, at, start), np.insert(self.length, at, length)
        self.used = np.insert(self.used, at, False)

    def _forget(self) -> None:
        """Keep the units that were asked for again, if the store is full."""
        if len(self.keys) < MOST_UNITS and len(self.bytes) < MOST_BYTES:
            return
        keep = self.used
        if keep.sum() >= MOST_UNITS // 2 or self.size[keep].sum() >= MOST_BYTES // 2:
            keep = np.zeros(len(self.used), bool)
        self.pool = self.pool[_ragged(self.start[keep], self.length[keep])]
        self.bytes = self.bytes[_ragged(self.at[keep], self.size[keep])]
        self.size = self.size[keep]
        self.at = np.cumsum(self.size) - self.size
        self.keys, self.length = self.keys[keep], self.length[keep]
        self.start = np.cumsum(self.length, dtype=np.int64) - self.length
        self.used = np.zeros(len(self.keys), bool)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids end."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
            a, b = self._chunk(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            ids.append(a)
            counts.append(b)
        return np.concatenate(ids), np.cumsum(np.concatenate(counts))

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        self._forget()
        starts, letter = unit_starts(data, offsets)
        ends = np.r_[starts[1:], len(data)]
        keys, first, which = np.unique(span_hashes(data, starts, ends, seed=7), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.used[at[known]] = True
        missing = np.flatnonzero(~known)
        if len(missing):
            s, e = starts[first[missing]], ends[first[missing]]
            letters = np.r_[0, np.cumsum(letter)]
            plain = (data[s] == 32) & (letters[e] - letters[s] == e - s - 1) & (e - s > 1) & (e - s <= LONGEST_KEPT)
            raw = data.tobytes()
            self._learn(keys[missing], [raw[x:y] for x, y in zip(s.tolist(), e.tolist())], plain)
            at = np.searchsorted(self.keys, keys)
        length = self.length[at][which].astype(np.int64)
        ids = self.pool[_ragged(self.start[at][which], length)]
        upto = np.r_[0, np.cumsum(length)]
        edge = upto[np.searchsorted(starts, offsets)]
        counts = np.diff(edge)
        odd = np.r_[np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)), self._strange(data, starts, ends - starts, at[which])]
        if len(odd):
            return self._with_whole(data, offsets, ids, edge, np.unique(np.searchsorted(offsets, odd, side="right") - 1))
        return ids, counts

    def _strange(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Places of units that are not the remembered one of their hash."""
        even = self.size[unit] == size
        if not even.all():
            other = starts[~even]
            starts, size, unit = starts[even], size[even], unit[even]
            data = data[_ragged(starts, size)]
        else:
            other = starts[:0]
        differ = np.flatnonzero(self.bytes[_ragged(self.at[unit], size)] != data)
        return np.r_[other, starts[np.unique(np.searchsorted(np.cumsum(size), differ, side="right"))]] if len(differ) else other

    def _with_whole(self, data, offsets, ids, edge, rows):
        """The same, with the texts ``rows`` encoded in one piece each."""
        parts = [ids[edge[k] : edge[k + 1]] for k in range(len(offsets) - 1)]
        for k, got in zip(rows, self._encode([data[offsets[k] : offsets[k + 1]].tobytes().decode() for k in rows])):
            parts[k] = got
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one after another."""
    total = np.cumsum(length, dtype=np.int64)
    n = int(total[-1]) if len(total) else 0
    return np.arange(n) + np.repeat(start - (total - length), length)


@lru_cache(maxsize=1)
def encoder(path: str) -> UnitEncoder:
    """This worker process's encoder for a tokenizer file, for tasks that read many small groups."""
    return UnitEncoder(path)
