"""Language of words and documents by a linear-chain conditional random field.

Each word has affix, character n-gram, whole-word and lexicon features; transitions
between the languages of neighbouring words are learned. Training sequences are spliced
from segments of documents of different languages, so that switches occur. Posteriors
come from forward-backward; it runs in blocks of words whose transfer matrices are
multiplied first, so that long documents are as fast as short ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .blocks import drawn
from .textkit import U64, batches_of_bytes, mix, span_hashes, text_bytes, trimmed, word_spans

DIMENSIONS = 1 << 16
NGRAMS = (1, 2, 3, 4)
BLOCK = 32
CHUNK_BYTES = 4 << 20
#: Most documents of a language, and characters of one, in the sample that training uses.
SAMPLE_DOCS, SAMPLE_BYTES = 250, 10_000
#: Languages learned at most, the commonest ones: training texts pass through the driver.
MOST_LANGUAGES = 100
LEXICON_WORDS = 200

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _fold(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 capitals."""
    out = data.copy()
    upper = (data >= 65) & (data <= 90)
    out[upper] += 32
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3
    latin = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[latin] += 32
    return out


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature indices of each word, where each word's begin, and a hash of its letters.

    Only letters count; a word without letters has no feature.
    """
    length = ends - starts
    at = np.arange(length.sum()) + np.repeat(starts - (np.cumsum(length) - length), length)
    word = np.repeat(np.arange(len(starts)), length)
    data = data[at] if len(at) else data[:0]
    keep = _LETTER[data]
    data, word = data[keep], word[keep]
    n = np.bincount(word, minlength=len(starts))
    # Marked words: 1, letters, 2; words without letters take no room.
    room = np.where(n > 0, n + 2, 0)
    first = np.cumsum(room) - room
    marked = np.zeros(int(room.sum()), U64)
    inner = np.arange(len(data)) + 2 * np.cumsum(n > 0)[word] - 1 if len(data) else np.zeros(0, np.int64)
    marked[inner] = data
    has = n > 0
    marked[first[has]] = 1
    marked[(first + room - 1)[has]] = 2
    owner = np.repeat(np.arange(len(starts)), room)
    code = np.zeros(len(marked), U64)
    found_word, found = [], []
    for k in range(1, max(NGRAMS) + 1):
        code = (code[: len(marked) - k + 1] << U64(8)) | marked[k - 1 :] if k > 1 else marked.copy()
        if k in NGRAMS and len(code):
            same = owner[: len(code)] == owner[k - 1 :]
            found_word.append(owner[: len(code)][same])
            found.append(mix(code[same] + (U64(k) << U64(40))))
    bounds = np.cumsum(room)
    whole = np.zeros(len(starts), U64)
    if len(marked):
        whole[has] = mix(span_hashes((marked & U64(255)).astype(np.uint8), first[has], bounds[has], seed=11) | U64(1))
    found_word.append(np.flatnonzero(has))
    found.append(mix(whole[has]))
    owner, index = np.concatenate(found_word), (np.concatenate(found) >> U64(48)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    count = np.bincount(owner, minlength=len(starts))
    return index[order], np.cumsum(count) - count, whole


@dataclass(frozen=True)
class Crf:
    labels: tuple[str, ...]
    weight: np.ndarray  # (DIMENSIONS + 1) x labels; the last row is zero
    transition: np.ndarray
    lexicon_keys: np.ndarray
    lexicon: np.ndarray  # lexicon words x labels, 0 or 1
    lexicon_weight: np.ndarray

    def lexicon_rows(self, whole: np.ndarray) -> np.ndarray:
        if not len(self.lexicon_keys):
            return np.zeros((len(whole), len(self.labels)))
        at = np.minimum(np.searchsorted(self.lexicon_keys, whole), len(self.lexicon_keys) - 1)
        return np.where((self.lexicon_keys[at] == whole)[:, None], self.lexicon[at], 0.0)

    def emissions(self, index: np.ndarray, first: np.ndarray, whole: np.ndarray) -> np.ndarray:
        if not len(first):
            return np.zeros((0, len(self.labels)))
        count = np.diff(np.r_[first, len(index)])
        sums = np.add.reduceat(self.weight.astype(np.float32)[np.r_[index, DIMENSIONS]], np.minimum(first, len(index)), axis=0)
        sums[count == 0] = 0
        return sums + self.lexicon_rows(whole) @ self.lexicon_weight


def posteriors(emission: np.ndarray, doc: np.ndarray, docs: int, transition: np.ndarray) -> np.ndarray:
    """Label posteriors of each word by forward-backward over each document's chain."""
    k = emission.shape[1]
    if not len(emission):
        return emission
    n = np.bincount(doc, minlength=docs)
    blocks = -(-n // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    b, t = first_block[doc] + place // BLOCK, place % BLOCK
    total = int(blocks.sum())
    # Time comes first, so that each step works on one contiguous slice. What is padded
    # lies at the end of a document's last block, after every word.
    e = np.ones((BLOCK, total, k), np.float32)
    e[t, b] = np.exp(emission - emission.max(axis=1, keepdims=True))
    a = np.exp(transition - transition.max()).astype(np.float32)
    # A chain starts from a uniform state, so its first word has no transition.
    heads = first_block[n > 0]
    last = (first_block + blocks - 1)[n > 0]
    used = (n - (blocks - 1) * BLOCK)[n > 0]
    whole = np.tile(np.eye(k, dtype=np.float32), (total, 1, 1))
    for s in range(BLOCK):
        step = (whole.reshape(-1, k) @ a).reshape(total, k, k)
        if s == 0:
            step[heads] = whole[heads]
        step *= e[s, :, None, :]
        if s % 4 == 3:
            step /= np.maximum(step.reshape(total, -1).sum(axis=1), 1e-30)[:, None, None]
        whole = step
    alpha, beta = np.full((total, k), 1.0 / k, np.float32), np.full((total, k), 1.0 / k, np.float32)
    for s in range(1, int(blocks.max())):
        at = first_block[blocks > s] + s
        x = np.einsum("bi,bij->bj", alpha[at - 1], whole[at - 1])
        alpha[at] = x / np.maximum(x.sum(axis=1, keepdims=True), 1e-30)
    whole[last] = _short_products(e, a, last, used)
    for s in range(int(blocks.max()) - 2, -1, -1):
        at = first_block[blocks > s + 1] + s
        x = np.einsum("bij,bj->bi", whole[at + 1], beta[at + 1])
        beta[at] = x / np.maximum(x.sum(axis=1, keepdims=True), 1e-30)
    forward = np.empty((BLOCK, total, k), np.float32)
    for s in range(BLOCK):
        x = alpha @ a
        if s == 0:
            x[heads] = alpha[heads]
        x *= e[s]
        x /= np.maximum(x.sum(axis=1, keepdims=True), 1e-30)
        alpha = forward[s] = x
    for s in range(BLOCK - 1, -1, -1):
        padded = last[used <= s]
        beta[padded] = 1.0 / k
        forward[s] *= beta
        x = (beta * e[s]) @ a.T
        x /= np.maximum(x.sum(axis=1, keepdims=True), 1e-30)
        x[padded] = 1.0 / k
        beta = x
    out = forward[t, b]
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-30)


def _short_products(e: np.ndarray, a: np.ndarray, rows: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Transfer matrices of blocks of which only the first ``used`` words exist."""
    k = a.shape[0]
    out = np.tile(np.eye(k, dtype=np.float32), (len(rows), 1, 1))
    for s in range(int(used.max())):
        on = used > s
        step = (out[on].reshape(-1, k) @ a).reshape(-1, k, k) * e[s, rows[on], None, :]
        out[on] = step / np.maximum(step.reshape(len(step), -1).sum(axis=1), 1e-30)[:, None, None]
    return out


def train(texts: list[str], labels: list[str], sequences: int = 1200, words: int = 80, rounds: int = 6, seed: int = 3) -> Crf:
    """Fit by gradient ascent (Adam) on the likelihood of spliced sequences."""
    names = tuple(sorted(set(labels)))
    k = len(names)
    rng = np.random.default_rng(seed)
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    data = _fold(data)
    starts, ends, doc = word_spans(data, offsets)
    language = np.array([names.index(x) for x in labels], np.int64)
    # Features are made once for each distinct word.
    _, sample, kind = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    index, first, whole = word_features(data, starts[sample], ends[sample])
    keys, which = np.unique(whole, return_inverse=True)
    table = np.zeros((len(keys), k))
    np.add.at(table, (which[kind], language[doc]), 1.0)
    table[keys == 0] = 0
    common = np.zeros(table.shape, bool)
    for c in range(k):
        top = np.argsort(-table[:, c], kind="stable")[:LEXICON_WORDS]
        common[top, c] = table[top, c] > 1
    chosen = common.any(axis=1)
    crf = Crf(names, np.zeros((DIMENSIONS + 1, k)), np.zeros((k, k)), keys[chosen], common[chosen].astype(np.float64), np.zeros((k, k)))
    if k < 2:
        return crf
    by = [np.flatnonzero(language == c) for c in range(k)]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    chains: list[np.ndarray] = []
    for _ in range(sequences):
        chain: list[np.ndarray] = []
        while sum(map(len, chain)) < words:
            d = rng.choice(by[rng.integers(k)])
            size = int(rng.integers(5, 40))
            lo, hi = bounds[d], bounds[d + 1]
            if hi > lo:
                s = int(rng.integers(lo, max(lo + 1, hi - size)))
                chain.append(np.arange(s, min(hi, s + size)))
            elif not len(starts):
                return crf
        chains.append(np.concatenate(chain)[:words])
    after = np.r_[first[1:], len(index)]
    moment = [[np.zeros_like(w), np.zeros_like(w)] for w in (crf.weight, crf.transition, crf.lexicon_weight)]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(sequences)
        for at in range(0, sequences, 60):
            batch = [chains[i] for i in order[at : at + 60]]
            token = np.concatenate(batch)
            chain = np.repeat(np.arange(len(batch)), [len(c) for c in batch])
            word = kind[token]
            size = after[word] - first[word]
            flat = index[np.arange(size.sum()) + np.repeat(first[word] - (np.cumsum(size) - size), size)]
            lexicon = crf.lexicon_rows(whole[word])
            emission = crf.emissions(flat, np.cumsum(size) - size, whole[word])
            p = posteriors(emission, chain, len(batch), crf.transition)
            truth = np.eye(k)[language[doc[token]]]
            gap = (truth - p) / len(token)
            grad = np.zeros_like(crf.weight)
            np.add.at(grad, flat, np.repeat(gap, size, axis=0))
            # Transitions: observed pairs less expected ones, from pairwise posteriors of neighbours.
            pairs = np.flatnonzero(chain[1:] == chain[:-1])
            hidden = _pair_posteriors(emission, chain, len(batch), crf.transition, pairs)
            seen = truth[pairs].T @ truth[pairs + 1]
            steps = (grad - 1e-7 * crf.weight, (seen - hidden) / len(token), lexicon.T @ gap)
            step += 1
            for w, g, (m, v) in zip((crf.weight, crf.transition, crf.lexicon_weight), steps, moment):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                w += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            crf.weight[DIMENSIONS] = 0
    return crf


def _pair_posteriors(emission, chain, n, transition, pairs) -> np.ndarray:
    """Expected transition counts: posteriors of each label clamped on the left word of a pair."""
    k = emission.shape[1]
    size = np.bincount(chain, minlength=n)
    longest = int(size.max())
    at = np.cumsum(size) - size
    e = np.zeros((n, longest, k))
    live = np.arange(longest)[None, :] < size[:, None]
    e[live] = np.exp(emission - emission.max(axis=1, keepdims=True))
    a = np.exp(transition - transition.max())
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    alpha[:, 0] = e[:, 0]
    for t in range(1, longest):
        x = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300)
    for t in range(longest - 2, -1, -1):
        x = (beta[:, t + 1] * e[:, t + 1]) @ a.T
        beta[:, t] = np.where(live[:, t + 1, None], x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300), 1.0)
    left = alpha[:, :-1, :, None] * a[None, None] * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    left = left[live[:, 1:]]
    return (left / np.maximum(left.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)


def training_sample(docs: DataFrame, most: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES, languages: int = MOST_LANGUAGES) -> tuple[list[str], list[str]]:
    """At most ``most`` texts of each of the ``languages`` commonest languages, picked by a hash of id and text; of a longer one a span of ``most_bytes`` characters at a hashed place.

    Equal rows are picked once.
    """
    usable = docs.filter((F.octet_length("text") > 0) & F.col("lang").isNotNull())
    at = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(F.length("text") - F.lit(most_bytes), F.lit(1))).cast("int")
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    return _pick(usable.withColumn("draw", F.xxhash64("doc_id", "text", F.lit(5))), at, {r["lang"]: r["count"] for r in counts}, most, most_bytes)


def _pick(usable: DataFrame, at: Column, counts: dict[str, int], most: int, most_bytes: int) -> tuple[list[str], list[str]]:
    """About 1.2 times ``most`` rows of each language reach the driver, which keeps the ``most`` that are drawn first."""
    pick = F.lit(False)
    for name, n in counts.items():
        pick = pick | ((F.col("lang") == name) & drawn(F.col("draw"), 1.2 * most, n))
    text = F.when(F.length("text") > most_bytes, F.substring(F.col("text"), at + 1, F.lit(most_bytes))).otherwise(F.col("text"))
    rows = usable.filter(pick).select("doc_id", text.alias("text"), "lang", "draw").dropDuplicates(["lang", "draw"]).collect()
    taken: dict[str, int] = {}
    texts, labels = [], []
    for r in sorted(rows, key=lambda r: (r["draw"], r["lang"])):
        if taken.get(r["lang"], 0) < most:
            taken[r["lang"]] = taken.get(r["lang"], 0) + 1
            texts.append(r["text"])
            labels.append(r["lang"])
    return texts, labels


def _document_rows(crf: Crf, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    docs = len(offsets) - 1
    if not crf.labels:
        return ["und"] * docs, np.zeros(docs), [[] for _ in range(docs)]
    raw = data
    data = _fold(data)
    starts, ends, doc = word_spans(data, offsets)
    keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    order = np.argsort(first)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    index, begin, whole = word_features(data, starts[first[order]], ends[first[order]])
    emission = crf.emissions(index, begin, whole)[rank[which]] if len(starts) else np.zeros((0, len(crf.labels)))
    lettered = whole[rank[which]] != 0 if len(starts) else np.zeros(0, bool)
    p = posteriors(emission, doc, docs, crf.transition)
    votes = np.stack([np.bincount(doc[lettered], p[lettered, c], docs) for c in range(len(crf.labels))], axis=1) if len(crf.labels) else np.zeros((docs, 0))
    total = votes.sum(axis=1)
    best = votes.argmax(axis=1) if len(crf.labels) else np.zeros(docs, int)
    names, scores = [], np.zeros(docs)
    ascii_letters = np.r_[0, np.cumsum(((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122)))][offsets]
    for d in range(docs):
        has = total[d] > 0 and (ascii_letters[d + 1] > ascii_letters[d] or any(c.isalpha() for c in raw[offsets[d] : offsets[d + 1]].tobytes().decode()))
        names.append(crf.labels[best[d]] if has else "und")
        scores[d] = votes[d, best[d]] / total[d] if has else 0.0
    word_label = p.argmax(axis=1) if len(p) else np.zeros(0, int)
    change = np.flatnonzero(np.r_[True, (word_label[1:] != word_label[:-1]) | (doc[1:] != doc[:-1])]) if len(p) else np.zeros(0, int)
    base = np.searchsorted(doc, np.arange(docs + 1))
    runs: list[list[dict]] = [[] for _ in range(docs)]
    for s, e in zip(change, [*change[1:], len(p)]):
        d = doc[s]
        runs[d].append({"start": int(s - base[d]), "end": int(e - base[d]), "lang": crf.labels[word_label[s]]})
    return names, scores, runs


def identify(docs: DataFrame, fold, held_out_fold: int = 0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, runs) of every row of ``docs``.

    The field is trained on texts and non-null languages of documents outside
    ``held_out_fold``, on a sample of at most SAMPLE_DOCS texts a language, of each at most SAMPLE_BYTES characters. ``runs`` are the
    word runs of one language in the text; ``lang_pred`` has the largest sum of word
    posteriors and ``score`` its share. Null and empty texts and texts without letters
    give ``und`` and 0, as do all texts if there is nothing to learn from. Null ids count
    as fold 0. Repeated rows are scored alike. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(fold, F.lit(0)).cast("int").alias("fold"))
    crf = train(*training_sample(docs.filter(F.col("fold") != held_out_fold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in trimmed(batches):
            data, offsets = text_bytes(batch.column("text"))
            held = np.asarray(batch.column("fold").to_numpy()) == held_out_fold
            for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
                names, scores, runs = _document_rows(crf, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(i, j - i), "held_out": pa.array(held[i:j]), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores),
                    "runs": pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))),
                })

    return docs.select("doc_id", "text", "fold").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, runs array<struct<start:int,end:int,lang:string>>")
