"""Benchmark decontamination by latent semantic retrieval.

Texts are read as overlapping passages. A randomised SVD of the TF-IDF vectors of them all, its
products summed by Spark, gives a latent space in which directions are whitened;
passages whose cosine with a benchmark passage is high are candidates. A candidate counts
when the longest common subsequence of words covers the item, or covers much of it and
its answer (the last sentence) stands there too, so that paraphrases are found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..scratch import discard, materialise
from .blocks import drawn
from .textkit import U64, batches_of_bytes, mix, span_hashes, text_bytes, trimmed, word_spans

#: Hashed terms and latent dimensions.
TERMS, LATENT = 1 << 14, 64
#: Words of a half passage; a passage is two neighbouring halves.
HALF = 16
#: Documents that the start of the latent space is made of, at most (about); it is fitted on all.
FIT_DOCS, FIT_BYTES = 3000, 20_000
COSINE = 0.45
#: Shares of an item that a common subsequence covers: alone, or with SURE of the answer.
COVERED, PARTLY, SURE = 0.75, 0.6, 0.9
#: Items of fewer words count only when covered whole.
SHORT = 8
#: Benchmark text and items that one pass over the corpus searches for, and that are screened together.
PASS_BYTES, PASS_ITEMS = 2 << 20, 20_000
SLICE_BYTES, SLICE_ITEMS = 64 << 10, 2000
#: Benchmark items that its start is made of, at most (about).
FIT_ITEMS = 20_000
CHUNK_BYTES = 1 << 19
#: Texts whose terms are told apart by flags; words of a frequent term in a chunk; entries of a table of frequent terms and halves.
FLAGGED, FREQUENT, TABLE = 1 << 10, 64, 1 << 20

_TRIM = np.zeros(256, bool)
_TRIM[33:48] = _TRIM[58:65] = _TRIM[91:97] = _TRIM[123:127] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each lower-case word (outer ASCII punctuation off), its text, and whether a sentence ends."""
    starts, ends, doc = word_spans(data, offsets)
    stop = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8)) if len(ends) else np.zeros(0, bool)
    left = np.arange(len(starts))
    for _ in range(4):
        # Words that lose nothing at one turn lose nothing later.
        a, b = starts[left], ends[left]
        last = _TRIM[data[b - 1]] & (b - a > 1)
        b = b - last
        first = _TRIM[data[a]] & (b - a > 1)
        starts[left], ends[left] = a + first, b
        left = left[last | first]
    return span_hashes(data, starts, ends), doc, stop


def _terms(words: np.ndarray) -> np.ndarray:
    return (mix(words) >> U64(50)).astype(np.int64)


def _halves(doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of each half passage, and its text."""
    n = np.bincount(doc, minlength=docs)
    count = -(-n // HALF)
    owner = np.repeat(np.arange(docs), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return (np.cumsum(n) - n)[owner] + place * HALF, owner


def _passages(sums: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of passages from those of halves, and the half that each starts with."""
    if not len(owner):
        return sums, owner
    pair = owner[1:] == owner[:-1]
    alone = np.r_[True, ~pair] & np.r_[~pair, True]
    first = np.flatnonzero(np.r_[pair, False] | alone)
    out = sums[first]
    two = ~alone[first]
    out[two] += sums[first[two] + 1]
    return out, first


def _chunks(batches: Iterator[pa.RecordBatch]):
    for batch in trimmed(batches):
        data, offsets = text_bytes(pc.utf8_lower(batch.column("text")))
        for i, j in batches_of_bytes(offsets, CHUNK_BYTES):
            words, doc, stop = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield batch, i, j, words, doc, stop


def _summed(df: DataFrame, part, parts: int = 8, kind=np.float64) -> np.ndarray:
    """Sum over all rows of what ``part`` returns per batch iterator, merged before it reaches the driver."""

    def first(batches):
        yield pa.RecordBatch.from_pydict({"total": pa.array([part(batches).astype(kind).tobytes()], pa.binary())})

    def merge(batches):
        total = 0
        for batch in batches:
            for x in batch.column("total"):
                total = total + np.frombuffer(x.as_buffer(), kind)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

    rows = df.mapInArrow(first, "total binary").repartition(parts).mapInArrow(merge, "total binary").collect()
    return sum(np.frombuffer(r["total"], kind).astype(np.float64) for r in rows)


def _holders(terms: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Number of the texts that hold each hashed term; a flag a text and term, unless there are many short texts."""
    if docs > FLAGGED:
        return np.bincount(np.unique(doc * TERMS + terms) % TERMS, minlength=TERMS)
    has = np.zeros(docs * TERMS, bool)
    has[doc * TERMS + terms] = True
    return np.count_nonzero(has.reshape(docs, TERMS), axis=0)


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Number of documents that hold each hashed term; the last entry counts documents."""

    def part(batches):
        total = np.zeros(TERMS + 1)
        for _, i, j, words, doc, _ in _chunks(batches):
            total[:TERMS] += _holders(_terms(words), doc, j - i)
            total[TERMS] += j - i
        return total

    total = _summed(docs.select("text"), part)
    return total if isinstance(total, np.ndarray) else np.zeros(TERMS + 1)


def latent_space(sample: DataFrame, corpus: DataFrame, items: DataFrame, idf: np.ndarray, weight: float, rounds: int = 2, seed: int = 6) -> np.ndarray:
    """Terms x LATENT matrix that maps TF-IDF vectors to whitened latent coordinates.

    A round multiplies the basis by A'A, A holding one unit row per passage. The first ``rounds``, over the
    rows of ``sample`` with their ``weight``, only give the last one a good start; that one reads all texts of ``corpus``
    and of ``items``, the latter with ``weight``, and basis and whitening are made of it alone.
    """

    def product(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
        weighted = (idf[:, None] * basis).astype(np.float32)

        def part(batches):
            total = np.zeros((TERMS, basis.shape[1]))
            for batch, i, j, words, doc, _ in _chunks(batches):
                if not len(words):
                    continue
                weight = batch.column("weight").to_numpy()[i:j]
                term = _terms(words)
                starts, owner = _halves(doc, j - i)
                halves = _half_sums(term, starts, weighted)
                norms = np.add.reduceat(idf[term] ** 2, starts)
                y, first = _passages(halves, owner)
                size, _ = _passages(norms.copy(), owner)
                y *= (weight[owner[first]] / np.maximum(size, 1e-9))[:, None]
                # A half lies in up to two passages: add both to its words.
                back = np.zeros_like(halves)
                back[first] += y
                second = first[np.r_[owner[1:] == owner[:-1], False][first]] + 1
                back[second] += y[np.searchsorted(first, second - 1)]
                held, sums = _term_sums(term, np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(words)])), back)
                total[held] += sums
            return total * idf[:, None]

        got = _summed(rows, part, 2, np.float32)
        return got.reshape(TERMS, -1) if isinstance(got, np.ndarray) else np.zeros((TERMS, basis.shape[1]))

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(TERMS, LATENT)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(product(sample, basis))[0]
    alike = F.lit(1.0).alias("weight")
    of_corpus, of_items = product(corpus.select("text", alike), basis), product(items.select("text", alike), basis)
    # Weights say which directions matter; whitening by them would shrink those of few items.
    image, start = of_corpus + of_items, basis
    basis = np.linalg.qr(of_corpus + weight * of_items)[0]
    # A'A is about Y (B'Y)^-1 Y' with Y = A'A B, so one pass is enough for its part in the new basis.
    core, seen = start.T @ image, basis.T @ image
    small = seen @ np.linalg.pinv((core + core.T) / 2, rcond=1e-6, hermitian=True) @ seen.T
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    scale = 1.0 / np.sqrt(np.maximum(values, max(values.max(), 1e-12) * 1e-6))
    return (idf[:, None] * (basis @ vectors) * scale).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _half_sums(terms: np.ndarray, starts: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Sum of the rows of each half passage, one word of every half at a time."""
    length = np.diff(np.r_[starts, len(terms)])
    total = space.take(terms[starts], axis=0)
    for k in range(1, HALF):
        more = np.flatnonzero(length > k)
        rows = space.take(terms[starts[more] + k], axis=0)
        if len(more) == len(starts):
            total += rows
        else:
            total[more] += rows
    return total


def _term_sums(terms: np.ndarray, half: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``terms``, and for each the sum of the rows of ``back`` of the halves in which its words stand.

    One word of every rare term is added at a time; frequent terms are a table of counts times ``back``.
    """
    order = np.argsort(terms.astype(np.uint16), kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(terms[order]) > 0])
    count, rows = np.diff(np.r_[at, len(terms)]), half[order]
    often = np.argsort(-count, kind="stable")
    frequent = int(np.count_nonzero(count > FREQUENT))
    sums = np.zeros((len(at), back.shape[1]), back.dtype)
    rare = often[frequent:]
    for k in range(min(FREQUENT, int(count.max(initial=0)))):
        rare = rare[: np.count_nonzero(count[rare] > k)]
        sums[rare] += back.take(rows[at[rare] + k], axis=0)
    step = max(1, TABLE // len(back))
    for lo in range(0, frequent, step):
        some = often[lo : min(lo + step, frequent)]
        size = count[some]
        word = np.arange(size.sum()) + np.repeat(at[some] - (np.cumsum(size) - size), size)
        table = np.bincount(np.repeat(np.arange(len(some)), size) * len(back) + rows[word], minlength=len(some) * len(back))
        sums[some] = table.reshape(len(some), -1).astype(back.dtype) @ back
    return terms[order][at], sums


def _project(words: np.ndarray, doc: np.ndarray, docs: int, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit latent vectors of passages, the text of each, and its first word."""
    starts, owner = _halves(doc, docs)
    if not len(words):
        return np.zeros((0, LATENT), np.float32), owner, starts
    vectors, first = _passages(_half_sums(_terms(words), starts, space), owner)
    return _unit(vectors), owner[first], starts[first]


@dataclass(frozen=True)
class Items:
    """Benchmark items: words, answer words, and latent passages."""

    ids: np.ndarray
    words: list[list[int]]
    answers: list[list[int]]
    #: Sorted words of all items; which of them each item has, as packed bits, and their number.
    vocabulary: np.ndarray
    has: np.ndarray
    n_distinct: np.ndarray
    vectors: np.ndarray
    owner: np.ndarray


def _row_bits(vocabulary: np.ndarray) -> int:
    return -(-max(1, len(vocabulary)) // 64) * 64


def _packed(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=1).view(U64)


def _read_items(ids: list[int], texts: list[str], space: np.ndarray) -> Items:
    data, offsets = text_bytes(pc.utf8_lower(pa.array(texts, pa.large_string())))
    words, doc, stop = words_of(data, offsets)
    vectors, owner, _ = _project(words, doc, len(texts), space)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    lists, answers = [], []
    for k in range(len(texts)):
        w, s = words[at[k] : at[k + 1]].tolist(), np.flatnonzero(stop[at[k] : at[k + 1]])
        s = s[s < len(w) - 1]
        cut = int(s[-1]) + 1 if len(s) else 2 * len(w) // 3
        lists.append(w)
        answers.append(w[cut:])
    vocabulary = np.unique(words)
    has = np.zeros((len(texts), _row_bits(vocabulary)), np.uint8)
    has[doc, np.searchsorted(vocabulary, words)] = 1
    ids = np.array(ids, object)
    return Items(ids, lists, answers, vocabulary, _packed(has), has.sum(axis=1, dtype=np.int64), vectors, owner)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits of one long integer."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := where.get(x, 0):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _judge(item: list[int], answer: list[int], region: list[int]) -> tuple[float, bool]:
    share = common_subsequence(item, region) / len(item)
    if len(item) < SHORT:
        return share, share == 1.0
    if share >= COVERED:
        return share, True
    return share, share >= PARTLY and bool(answer) and common_subsequence(answer, region) >= SURE * len(answer)


def _slices(ids: list[int], texts: list[str], space: np.ndarray) -> list[Items]:
    """The items in runs of bounded size, so that the tables of their words stay small together."""
    out, at, size = [], 0, 0
    for k, text in enumerate(texts):
        if k > at and (size + len(text) > SLICE_BYTES or k - at >= SLICE_ITEMS):
            out.append(_read_items(ids[at:k], texts[at:k], space))
            at, size = k, 0
        size += len(text)
    return [*out, _read_items(ids[at:], texts[at:], space)]


def _hits(words, doc, docs: int, passages, items: Items) -> list[tuple[int, int, float, int, int]]:
    """(text, item, covered share, first word, end word) of the confirmed candidates, the best of each pair."""
    vectors, owner, first = passages
    base = np.searchsorted(doc, np.arange(docs + 1))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    length = np.array([len(w) for w in items.words])
    longest = int(length.max())
    place = np.minimum(np.searchsorted(items.vocabulary, words), len(items.vocabulary) - 1)
    known = items.vocabulary[place] == words
    bits = _row_bits(items.vocabulary)
    step = int(np.clip((1 << 23) // bits, 16, 4096))
    for lo in range(0, len(vectors), step):
        near, q = np.nonzero(vectors[lo : lo + step] @ items.vectors.T >= COSINE)
        if not len(near):
            continue
        pairs = np.unique(near * len(items.ids) + items.owner[q])
        near, item_of = pairs // len(items.ids), pairs % len(items.ids)
        # Words that are nowhere near can't be in a common subsequence.
        rows, row = np.unique(near, return_inverse=True)
        d, at = owner[lo + rows], first[lo + rows]
        begin, stop = np.maximum(base[d], at - longest), np.minimum(base[d + 1], at + 2 * HALF + longest)
        size = stop - begin
        word = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        owner_row = np.repeat(np.arange(len(rows)), size)
        around = np.zeros((len(rows), bits), np.uint8)
        around[owner_row[known[word]], place[word[known[word]]]] = 1
        common = np.bitwise_count(_packed(around)[row] & items.has[item_of]).sum(axis=1, dtype=np.int64)
        good = np.flatnonzero(items.n_distinct[item_of] - common <= (1 - PARTLY) * length[item_of])
        for d, k, at in zip(owner[lo + near[good]].tolist(), item_of[good].tolist(), first[lo + near[good]].tolist()):
            item, low, high = items.words[k], int(base[d]), int(base[d + 1])
            start, end = max(low, at - len(item)), min(high, at + 2 * HALF + len(item))
            share, found = _judge(item, items.answers[k], words[start:end].tolist())
            if found and share > best.get((d, k), (-1.0,))[0]:
                best[d, k] = (share, start - low, end - low)
    return [(d, k, *v) for (d, k), v in best.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, item_id, covered, start, end): benchmark items that documents hold.

    ``covered`` is the share of the item's words in the longest common subsequence with
    the words from ``start`` to ``end`` of the document. Documents without a row are clean.

    Null and blank texts and items match nothing. Repeated rows of a document give repeated
    rows; of equal items each matches. Texts of any length are read whole. Other columns
    are ignored, but for those in ``carry``, which follow the result's. An empty table on
    either side gives an empty result. The benchmark passes through the driver, about
    PASS_BYTES of text or PASS_ITEMS items at a time, each pass written before the next; the corpus does not.
    """
    spark: SparkSession = docs.sparkSession
    extra = [f"carried_{i}" for i in range(len(carry))]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(x) for c, x in zip(carry, extra)))
    schema = StructType([*StructType.fromDDL("doc_id long, item_id long, covered double, start int, end int").fields, *(StructField(x, docs.schema[x].dataType, True) for x in extra)])
    bench = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "") != "")
    size = bench.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    n_items = size["n"]
    frequency = document_frequencies(docs)
    n_docs = int(frequency[TERMS])
    if not n_items or not n_docs:
        return spark.createDataFrame([], schema).withColumnsRenamed(dict(zip(extra, carry)))
    idf = np.log((1.0 + n_docs) / (1.0 + frequency[:TERMS])) + 0.05
    pick = drawn(F.xxhash64("doc_id", "text", F.lit(6)), FIT_DOCS, n_docs)
    corpus = docs.filter(pick & (F.octet_length("text") <= FIT_BYTES)).select("text", F.lit(1.0).alias("weight")).distinct()
    # The benchmark's directions weigh as much as the corpus's.
    known = bench.filter(drawn(F.xxhash64("item_id", "text", F.lit(6)), FIT_ITEMS, n_items)).distinct()
    weight = max(1.0, 10.0 * min(FIT_DOCS, n_docs) / min(n_items, FIT_ITEMS))
    sample = materialise(corpus.union(known.select("text", F.lit(weight).alias("weight"))).repartition(2), "passages")
    space = latent_space(sample, docs, bench, idf, max(1.0, 10.0 * n_docs / n_items))
    discard(sample)

    def found(rows: list) -> DataFrame:
        slices = _slices([r["item_id"] for r in rows], [r["text"] for r in rows], space)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, i, j, words, doc, _ in _chunks(batches):
                passages = _project(words, doc, j - i, space)
                for items in slices:
                    hits = _hits(words, doc, j - i, passages, items)
                    if hits:
                        at = pa.array([i + h[0] for h in hits])
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": batch.column("doc_id").take(at), "item_id": pa.array(items.ids[[h[1] for h in hits]], pa.int64()), "covered": pa.array([h[2] for h in hits], pa.float64()),
                            "start": pa.array([h[3] for h in hits], pa.int32()), "end": pa.array([h[4] for h in hits], pa.int32()),
                            **{c: batch.column(c).take(at) for c in extra},
                        })

        return docs.mapInArrow(run, schema)

    passes = max(1, -(-size["b"] // PASS_BYTES), -(-n_items // PASS_ITEMS))
    out = None
    for k in range(passes):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").collect()
        if rows:
            part = found(rows) if passes == 1 else materialise(found(rows), "hits")
            out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed(dict(zip(extra, carry)))
