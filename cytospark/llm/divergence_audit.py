"""How far the sources of a language diverge from each other, and by which terms.

Each batch of documents gives one row per (language, term, source) in it, with the
documents and occurrences it stands for and the first of those documents. The rows are
dealt out by (language, term) and sorted by (language, term, source, document); a scan of
each sorted stream folds runs of equal keys into document frequencies and counts, so no
table of terms is held. A second scan, over the terms kept, adds what each contributes
to every pair of sources and emits the terms themselves.

Probabilities are whole billionths and everything is done in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..scratch import materialise
from .textkit import text_bytes, trimmed, word_spans

#: Letters of terms: ASCII letters and all that is not ASCII; the rest is between terms.
_BETWEEN = np.ones(256, bool)
_BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = np.arange(97, 123)
#: Text bytes counted at a time, terms of which a scan adds up the pairs at a time, cells of a task's table of pairs.
CHUNK_BYTES, TERMS, CELLS = 8 << 20, 512, 1 << 21
#: Groups (language, source) whose totals each task gets; the result has a row for each pair of sources of a language.
MOST_GROUPS = 1_000_000
BILLION = 1_000_000_000


def _share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(BILLION * n / total) for n <= total, by long division in steps of a thousand, so that nothing overflows."""
    out, rest = n // total, n % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return out + 1


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, one after another, and the text of each."""
    starts, ends, doc = word_spans(data, offsets, _BETWEEN)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    np.subtract.at(inside, ends, 1)
    letters = _LOWER[data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]]
    at = np.r_[0, np.cumsum(ends - starts)]
    kind = pa.large_string()
    return pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(letters)]), doc


def _partials(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row per (lang, term, source) of each chunk of documents."""
    for batch in trimmed(batches):
        data, offsets = text_bytes(batch.column("text"))
        langs, sources = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        i, n = 0, batch.num_rows
        while i < n:
            j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, side="right")) - 1))
            terms, doc = _terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            if len(terms):
                coded = terms.dictionary_encode()
                wide, code = len(coded.dictionary), coded.indices.to_numpy()
                # Occurrences of a term in a document, then documents and occurrences of a term in a group.
                both, times = np.unique(doc * wide + code, return_counts=True)
                row, term = both // wide + i, both % wide
                which = langs.indices.to_numpy()[row].astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()[row]
                keys, back = np.unique(which * wide + term, return_inverse=True)
                docs, total = np.bincount(back, minlength=len(keys)), np.zeros(len(keys), np.int64)
                np.add.at(total, back, times)
                first = np.full(len(keys), np.iinfo(np.int64).max)
                np.minimum.at(first, back, batch.column("row").to_numpy()[row])
                own = keys // wide
                yield pa.RecordBatch.from_pydict({
                    "lang": langs.dictionary.take(pa.array(own // len(sources.dictionary))), "term": coded.dictionary.take(pa.array(keys % wide)).cast(pa.string()),
                    "source": sources.dictionary.take(pa.array(own % len(sources.dictionary))), "document": pa.array(first), "docs": pa.array(docs), "n": pa.array(total),
                })
            i = j


def _changes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Positions at which a row's keys differ from those of the row before; the first row is one."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        col = table[k].combine_chunks()
        new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _fold(table: pa.Table) -> pa.Table:
    """Rows that are sorted by (lang, term, source), with those of equal keys added up."""
    at = _changes(table, ["lang", "term", "source"])
    out = table.select(["lang", "term", "source"]).take(pa.array(at))
    for c in ("docs", "n"):
        out = out.append_column(c, pa.array(np.add.reduceat(table[c].to_numpy(), at)))
    return out


def _scan(least_docs: int):
    """The run-length scan: sorted rows in, one row per kept term out."""

    def whole(table: pa.Table) -> pa.RecordBatch:
        at = _changes(table, ["lang", "term"])
        ends = np.r_[at[1:], table.num_rows]
        keep = np.add.reduceat(table["docs"].to_numpy(), at) >= least_docs
        rows = np.repeat(keep, ends - at)
        kept = table.filter(pa.array(rows))
        offsets = pa.array(np.r_[0, np.cumsum((ends - at)[keep])].astype(np.int32))
        lists = {name: pa.ListArray.from_arrays(offsets, kept[c].combine_chunks()) for name, c in (("sources", "source"), ("counts", "n"))}
        heads = table.select(["lang", "term"]).take(pa.array(at[keep]))
        return pa.RecordBatch.from_pydict({"lang": heads["lang"].combine_chunks(), "term": heads["term"].combine_chunks(), **lists})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = _fold(pa.Table.from_batches([batch]).drop_columns(["document"]))
            table = _fold(pa.concat_tables([rest, table])) if rest is not None else table
            # The last term may go on in the next batch.
            last = int(_changes(table, ["lang", "term"])[-1])
            if last:
                yield whole(table.slice(0, last))
            rest = table.slice(last)
        if rest is not None:
            yield whole(rest)

    return run


def _contributions(groups: dict[str, tuple[list[str], np.ndarray, int]], cells: int):
    """The second scan: what each kept term adds to every pair of sources of its language, and the terms that a source favours.

    ``groups`` has the sources, their totals and the number of kept terms of each language.
    A task adds up pairs of up to ``tile`` sources with all others; rows of one (lang, tile) come together.
    """
    place = {lang: pa.array(sources, pa.string()) for lang, (sources, _, _) in groups.items()}

    def pairs_of(lang: str, tile: int, table: np.ndarray) -> pa.RecordBatch:
        g, h = np.nonzero(np.ones(table.shape, bool))
        g = g + tile * _tile(len(place[lang]), cells)
        keep = g != h
        names = place[lang]
        return pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * int(keep.sum()), pa.string()), "source": names.take(pa.array(g[keep])), "part": pa.array(["pair"] * int(keep.sum()), pa.string()),
            "item": names.take(pa.array(h[keep])), "value": pa.array(table.ravel()[keep]),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            starts = _changes(table, ["lang", "tile"]) if table.num_rows else np.zeros(0, np.int64)
            for a, b in zip(starts, [*starts[1:], table.num_rows]):
                part = table.slice(a, b - a)
                lang, tile = part["lang"][0].as_py(), part["tile"][0].as_py()
                sources, totals, kept = groups[lang]
                size = _tile(len(sources), cells)
                lo, hi = tile * size, min(len(sources), (tile + 1) * size)
                if (lang, tile) != now:
                    if now:
                        yield pairs_of(*now, sums)
                    now, sums = (lang, tile), np.zeros((hi - lo, len(sources)), np.int64)
                step = max(1, min(TERMS, cells // ((hi - lo) * len(sources))))
                for i in range(0, part.num_rows, step):
                    some = part.slice(i, step).combine_chunks()
                    lists, numbers = some["sources"].combine_chunks(), some["counts"].combine_chunks()
                    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
                    counts = np.zeros((some.num_rows, len(sources)), np.int64)
                    term = np.searchsorted(ends, np.arange(ends[-1]), side="right")
                    counts[term, pc.index_in(lists.flatten(), place[lang]).to_numpy()] = numbers.flatten().to_numpy()
                    p = _share(counts + 1, totals + kept)
                    d = p[:, lo:hi, None] - p[:, None, :]
                    sums += (d * d // p[:, None, :]).sum(axis=0)
                    if tile == 0:
                        q = _share(counts.sum(axis=1) + 1, totals.sum() + kept)[:, None]
                        t, g = np.nonzero((counts > 0) & (p > q))
                        value = (p - q) ** 2 // q
                        yield pa.RecordBatch.from_pydict({
                            "lang": pa.array([lang] * len(t), pa.string()), "source": place[lang].take(pa.array(g)), "part": pa.array(["term"] * len(t), pa.string()),
                            "item": some["term"].combine_chunks().take(pa.array(t)), "value": pa.array(value[t, g]),
                        })
        if now:
            yield pairs_of(*now, sums)

    return run


def _tile(sources: int, cells: int) -> int:
    """Sources of whose pairs with all others one task keeps the sums."""
    return max(1, min(sources, cells // max(1, sources)))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3, top: int = 200, cells: int = CELLS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, source, part, item, value, rank): each source of a language against its other sources, and its own terms.

    Part ``pair`` has every other source of the language, and the sum over the language's kept
    terms (those in ``least_docs`` documents or more) of f = floor((p - q)^2 / q), with p
    and q the smoothed billionths of the term in both. Part ``term`` has the ``top`` terms by f
    that the source uses more than its language does. Ties go to the item that is less in UTF-8.

    Null texts, languages and sources count as empty. Every row is a document, also where rows
    repeat. Texts of any length are read whole. A source without terms, or a
    language without kept terms, has its pairs all the same. An empty table gives an
    empty result, and other columns are ignored whatever their names. More than MOST_GROUPS
    (language, source) groups raise, since the totals of all go to every task.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    held = materialise(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")), "groups")
    if (n := held.count()) > MOST_GROUPS:
        raise ValueError(f"{n} groups of language and source; at most {MOST_GROUPS} can be compared")

    sent = rows.mapInArrow(lambda batches: _partials(batches, chunk_bytes), "lang string, term string, source string, document long, docs long, n long")
    order = ["lang", "term", "source", "document"]
    runs = sent.repartition("lang", "term").sortWithinPartitions(*order).mapInArrow(_scan(least_docs), "lang string, term string, sources array<string>, counts array<long>")
    runs = materialise(runs, "terms")
    totals = runs.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    kept = {r["lang"]: r["count"] for r in runs.groupBy("lang").count().collect()}  # no more than groups
    groups: dict[str, tuple[list[str], np.ndarray, int]] = {}
    found = held.select("lang", "source").join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    lists: dict[str, list[tuple[bytes, str, int]]] = {}
    for r in found.collect():  # at most MOST_GROUPS rows
        lists.setdefault(r["lang"], []).append((r["source"].encode(), r["source"], r["n"]))
    for lang, of in lists.items():
        of.sort()
        groups[lang] = [x[1] for x in of], np.array([x[2] for x in of], np.int64), kept.get(lang, 0)

    tiles = docs.sparkSession.createDataFrame([(lang, -(-len(s) // _tile(len(s), cells))) for lang, (s, _, _) in groups.items()], "lang string, tiles int")
    dealt = runs.join(F.broadcast(tiles), "lang").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles").sortWithinPartitions("lang", "tile")
    parts = materialise(dealt.mapInArrow(_contributions(groups, cells), "lang string, source string, part string, item string, value long"), "parts")
    # Languages of which no term is kept have pairs of value 0, and sums of the others are not changed by it.
    held = held.select("lang", "source")
    other = held.select("lang", F.col("source").alias("item"))
    none = held.join(other, "lang").filter("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = parts.filter("part = 'pair'").unionByName(none).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = parts.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms)
