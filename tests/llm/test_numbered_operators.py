"""The numbered operators against brute force, with nulls, ties, repeats and empty tables."""

import hashlib
import math
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cytospark.llm.arrow_sequences import SequenceFile, read_documents, write_sequences
from cytospark.llm.blocks import ordered_blocks
from cytospark.llm.decontaminate import contaminated
from cytospark.llm.language_crf import identify
from cytospark.llm.lm_scoring import score
from cytospark.llm import decontaminate, lm_scoring, near_dedup, permutation_index, substring_dedup
from cytospark.llm.near_dedup import near_duplicates
from cytospark.llm.packing import Limits, pack, pack_documents
from cytospark.llm.permutation_index import nearest
from cytospark.llm.quality import quality_scores
from cytospark.scratch import scratch_path
from cytospark.llm.substring_dedup import remove_repeats
from cytospark.llm.url_filters import match_captures

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, key string"


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = text(60), text(80)
    out = [text(rng.randint(1, 90)) for _ in range(30)]
    out += [text(10) + " " + passage + " " + text(9), passage + " " + text(5), text(3) + "\n" + passage]
    near = base.split()
    near[40] = "Changed"
    out += [base, base, " ".join(near), base.upper(), None, "", " \t\n", "one two three", "One two THREE", "x " * 300 + "y", text(3000)]
    return [(i * 3 + 1, t) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, 7, "k") for i, t in corpus()], SCHEMA).repartition(3)


def split(t):
    return [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", t or "")]


def fold_of(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def test_substring_dedup(docs):
    seen, want = set(), {}
    for i, t in corpus():
        w, cut = split(t), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                cut |= set(range(k, k + 20))
            seen.add(key)
        kept = " ".join(x for k, x in enumerate(w) if k not in cut)
        want[i] = (len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in remove_repeats(docs, block_bytes=4000).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 100
    assert remove_repeats(docs.limit(0)).count() == 0


def test_near_dedup(docs):
    sets = {}
    for i, t in corpus():
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in split(t)]
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in sets}
    assert sum(not v[2] for v in got.values()) >= 4


def exact_components(rows, percent=75):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := split(t.lower())) else set() for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in sets}


def test_near_dedup_of_large_groups(spark, monkeypatch):
    """Hot buckets and families in many blocks: copies, a chain whose ends are far apart, and unlike texts between."""
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(near_dedup, "FAMILY_BYTES", 1500)
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randint(1, 300)}" for _ in range(n)]
    base, chain, rows = text(90), text(70), []
    for k in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(90)] = f"c{k}"
        rows.append(w)
    for k in range(30):
        chain[(k * 11) % 70] = f"d{k}"
        rows.append(list(chain))
    rows += [[*base[:55], *text(35)] for _ in range(20)] + [text(60) for _ in range(20)]
    rng.shuffle(rows)
    rows = [(i * 7 + 3, " ".join(w)) for i, w in enumerate(rows)]
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    want = exact_components(rows)
    assert got == want and len(set(want.values())) < 60


def test_near_dedup_of_odd_rows(spark):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randint(1, 300)}" for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "x"), (9, b, None), (7, c, "x"), (7, c, "x"), (None, a, "x"), (None, None, "x"), (11, d, "x"), (12, None, "x"), (13, d, "x"), (13, c, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r["doc_id"] or -1, r["component_id"] or -1, r["kept"], r["c"] or "") for r in near_duplicates(df.withColumnRenamed("component_id", "class").withColumn("rep", F.lit(1)).withColumn("c", F.col("class")), carry=("c",)).collect()))
    assert got == sorted([(3, 3, True, "x"), (5, 3, False, "y"), (5, 3, False, "x"), (9, 3, False, ""), (7, 7, True, "x"), (7, 7, True, "x"), (-1, -1, True, "x"), (-1, -1, True, "x"), (11, 7, False, "x"), (12, 12, True, "x"), (13, 7, False, "x"), (13, 7, False, "x")])
    assert near_duplicates(df.limit(0)).count() == 0 and near_duplicates(df.filter("text is null")).count() == 2


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16)).astype(np.float32)
    x[7] = x[8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(v, v.filter("vec_id % 20 = 0"), k=20).collect():
        assert r["score"] == pytest.approx(float(x[r["query_id"]].astype(float) @ x[r["vec_id"]].astype(float)), abs=1e-9)
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    hits = 0
    for q in range(0, 300, 20):
        s = x.astype(float) @ x[q].astype(float)
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], i))[:20]
        assert sorted(got[q]) == list(range(1, 21))
        hits += len(set(best) & set(got[q].values()))
    assert hits >= 0.9 * 20 * 15


def recall(spark, rows, k=20, every=20):
    """Share of true neighbours that are found; ids, order, scores and the numbers of rows must be right anyway."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    v = spark.createDataFrame([(int(i), [float(c) for c in w]) for i, w in rows], "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in nearest(v, v.filter(f"vec_id % {every} = 0"), k=k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    place, hits, asked = {i: n for n, i in enumerate(ids.tolist())}, 0, ids[ids % every == 0]
    assert set(got) == set(asked.tolist())
    for q in asked.tolist():
        s = x @ x[place[q]]
        order = np.lexsort((ids, -s))
        best = [int(i) for i in ids[order] if i != q][:k]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, k + 1)) and q not in [m[1] for m in mine]
        assert np.allclose([m[2] for m in mine], [s[place[m[1]]] for m in mine], atol=1e-9)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len(set(best) & {m[1] for m in mine})
    return hits / (k * len(asked))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables")
def test_recall_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    assert recall(spark, [(r["vec_id"], r["embedding"]) for r in table.collect()]) >= 0.9


def test_recall_on_clusters_of_unequal_norms(spark):
    rng = np.random.default_rng(11)
    centre = rng.normal(size=(60, 24))
    x = (centre[rng.integers(60, size=9000)] + 0.4 * rng.normal(size=(9000, 24))) * np.exp(0.4 * rng.normal(size=(9000, 1)))
    assert recall(spark, list(enumerate(x.astype(np.float32))), every=60) >= 0.9


def test_nearest_with_ties_and_repeats(spark):
    """A third of the vectors are equal; ties go to the smaller id; odd rows take no part."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(240, 8)).astype(np.float32)
    x[rng.permutation(240)[:80]] = x[0] * 2
    assert recall(spark, [(i * 5, v) for i, v in enumerate(x)], k=7) >= 0.97
    rows = [(1, [1.0, 0.0]), (1, [0.0, 3.0]), (1, [0.0, 3.0]), (2, [1.0, 1.0]), (20, [0.0, 2.0]), (None, [9.0, 9.0]), (7, None), (8, []), (9, [0.0, 0.0]), (10, [float("inf"), 1.0]), (11, [None, 1.0]), (12, [1.0, 2.0, 3.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("file", F.lit(1)).withColumn("block", F.lit("x"))
    got = [tuple(r) for r in nearest(v, v.filter("vec_id % 20 = 0"), k=5).collect()]
    assert sorted(got) == [(20, 1, 1, 6.0), (20, 2, 2, 2.0)]
    assert sorted(tuple(r) for r in nearest(v, v.filter("vec_id = 1"), k=1).collect()) == [(1, 1, 20, 6.0)]
    assert nearest(v.limit(0), v, k=5).count() == 0 and nearest(v, v.limit(0), k=5).count() == 0


def test_nearest_by_small_blocks(spark, monkeypatch):
    """Many blocks, cut files and copies of blocks find no less than a few blocks; each block has its own least number of candidates."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(1500, 6)).round(1))] + [(1500 + i, [1.0, 2.0, 0.5, 0.5, 0.5, 3.0]) for i in range(400)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = lambda: {(r["query_id"], r["rank"]): r["score"] for r in nearest(v, v.filter("vec_id % 20 = 0"), k=9).collect()}
    no_worse = lambda a, b: a.keys() == b.keys() and all(a[x] >= b[x] - 1e-9 for x in b)
    few = found()
    monkeypatch.setattr(permutation_index, "LEAST_ROWS", 10)
    monkeypatch.setattr(permutation_index, "SPREAD", 60)
    many = found()
    assert no_worse(many, few)
    monkeypatch.setattr(permutation_index, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(permutation_index, "QUERY_BYTES", 600)
    assert no_worse(found(), few) and len(few) == 95 * 9
    x = np.array([e for _, e in rows], np.float32).astype(np.float64)
    true = x[::20] @ x.T
    true[np.arange(95), np.arange(0, 1900, 20)] = -np.inf
    true = -np.sort(-true, axis=1)[:, :9]
    assert np.mean([abs(many[q * 20, r + 1] - true[q, r]) < 1e-9 for q in range(95) for r in range(9)]) >= 0.9


def test_usable_vectors():
    values = [[1.0, 2.0], None, [], [0.0, 0.0], [3.0], [float("nan"), 1.0], [None, 2.0], [4.0, -1.0, 2.0], [float("-inf")], [5.0]]
    for kind, t in (("<f4", pa.float32()), ("<f8", pa.float64())):
        column = pa.array([[9.0], *values], pa.list_(t)).slice(1)
        got = permutation_index._usable(pa.array([0, 1, 2, 3, 4, 5, 6, 7, 8, None], pa.int64()), column, kind).to_pylist()
        assert [(r["id"], r["dim"], np.frombuffer(r["vec"], kind).tolist()) for r in got] == [(0, 2, [1.0, 2.0]), (4, 1, [3.0]), (7, 3, [4.0, -1.0, 2.0])]
        assert np.allclose([r["norm"] for r in got], [5**0.5, 3, 21**0.5])
    assert permutation_index._usable(pa.array([], pa.int64()), pa.array([], pa.list_(pa.float32())), "<f4").num_rows == 0


def ids_of(name, text, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_arrow_sequences(spark, docs):
    out = scratch_path(spark, "sequences")
    shards = write_sequences(docs, out, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, block_bytes=3000)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in read_documents(shards, out).collect()}
    start, want = 0, {}
    for i, t in corpus():
        ids = ids_of("byte_bpe_50k.json", t, 0)
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want
    flat = np.concatenate([ids_of("byte_bpe_50k.json", t, 0) for _, t in corpus()])
    at = 0
    for r in sorted(shards.collect(), key=lambda r: r["shard"]):
        with SequenceFile(r["path"] + ".arrow") as f:
            assert len(f) == -(-r["tokens"] // 2048)
            for k in reversed(range(len(f))):
                ids, mask = f.sequence(k)
                n = min(2048, r["tokens"] - 2048 * k)
                assert (ids[:n] == flat[at + 2048 * k :][:n]).all() and not ids[n:].any() and mask.to_pylist() == [True] * n + [False] * (2048 - n)
                assert not ids.flags.owndata
            with pytest.raises(IndexError):
                f.sequence(len(f))
        at += r["tokens"]


def test_arrow_sequences_of_odd_rows(spark):
    rows = [(7, "b b"), (None, "n"), (7, "a"), (7, "a"), (None, None), (2, "z " * 3000)]
    d = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, start int, path string").repartition(2)
    out = scratch_path(spark, "sequences")
    got = sorted(((r["start"], r["doc_id"], bytes(r["ids"])) for r in read_documents(write_sequences(d, out, public_tokenizers.path("byte_bpe_50k.json"), block_bytes=4000), out).collect()))
    at = 0
    for start, _, ids in got:
        assert start == at
        at += len(ids) // 4
    assert [i for _, i, _ in got] == [None, None, 2, 7, 7, 7]
    assert sorted(x for *_, x in got) == sorted(ids_of("byte_bpe_50k.json", t, 0).tobytes() for _, t in rows)
    assert read_documents(write_sequences(d.limit(0), out + "-0", public_tokenizers.path("byte_bpe_50k.json")), out + "-0").count() == 0


def test_blocks_split_what_is_large(spark):
    """Repeated and null ids fill several blocks; all blocks together keep the order."""
    rows = [(5, f"text {i} " + "w " * 40) for i in range(400)] + [(None, f"n {i} " + "w " * 40) for i in range(300)] + [(i * i, "x " * (i % 50)) for i in range(200)]
    d, total = ordered_blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text", 4000)
    got = [(r["block"], r["doc_id"] is not None, r["doc_id"] or 0, r["place"], len(r["text"])) for r in d.collect()]
    assert [g[0] for g in sorted(got, key=lambda g: g[1:4])] == sorted(g[0] for g in got)
    size = {}
    for b, *_, n in got:
        size[b] = size.get(b, 0) + n + 16
    assert total == sum(size.values()) and max(size.values()) < 0.1 * total
    assert len({g[0] for g in got if g[2] == 5}) > 5 and len({g[0] for g in got if not g[1]}) > 5


@pytest.mark.parametrize("spare", [10, 50])
def test_substring_dedup_of_odd_rows(spark, monkeypatch, spare):
    """Null and repeated ids: windows are removed where an earlier row of the order has them."""
    monkeypatch.setattr(substring_dedup, "SPARE_BITS", spare)
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randint(1, 99)}" for _ in range(n))
    a, b = text(50), text(45)
    rows = [(None, a), (None, text(30) + " " + a), (3, a), (3, a), (3, text(25) + "\x0b" + b), (9, b), (9, None), (4, " ")] + [(3, text(40)) for _ in range(60)]
    d = spark.createDataFrame([(i, t, 1, "k", 0) for i, t in rows], "doc_id long, text string, block int, keys string, place int").repartition(3)
    place = {r["text"]: r["p"] for r in d.select("text", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("p")).collect()}
    seen, want = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, place[r[1]])):
        w, cut = split(t), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                cut |= set(range(k, k + 20))
            seen.add(key)
        want.append((i or -1, len(w), " ".join(x for k, x in enumerate(w) if k not in cut), 1, "k"))
    out = remove_repeats(d, block_bytes=3000, carry=("block", "keys"))
    got = [(r["doc_id"] or -1, r["n_words"], r["kept"], r["block"], r["keys"]) for r in out.collect()]
    assert sorted(got) == sorted(want)


def test_packing(docs):
    rows = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in corpus():
        ids = b"".join(bytes(r["ids"]) for r in sorted(by_doc[i], key=lambda r: r["start"]))
        assert ids == ids_of("word_bpe_49k.json", t, 1).tobytes() and all(r["doc_tokens"] * 4 == len(ids) for r in by_doc[i])
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048


@pytest.mark.parametrize("limits", [Limits(tokens=256, segments=6, loss=40), Limits(tokens=64, segments=3, loss=100), Limits(loss=300)])
def test_packing_with_prompts(spark, limits):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        prompt = " ".join(f"word{rng.randint(1, 99)}" for _ in range(rng.choice((0, 5, 40, 200))))
        reply = " ".join(f"word{rng.randint(1, 99)}" for _ in range(rng.choice((0, 3, 30, 150))))
        rows.append((i, (prompt + " " + reply).strip(), len(ids_of("word_bpe_49k.json", prompt, 1)) - 1))
    rows += [(500, "word1 " * 30, None), (501, "word2 " * 30, -4), (502, "word3 " * 30, 10**6), (503, None, 3)]
    d = spark.createDataFrame(rows, "doc_id long, text string, prompt_tokens long").repartition(2)
    by_doc, by_seq = {}, {}
    for r in pack_documents(d, public_tokenizers.path("word_bpe_49k.json"), limits=limits, loss_from_col="prompt_tokens", batch_bytes=20_000).collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t, first in rows:
        ids, bears = ids_of("word_bpe_49k.json", t, 1), max(0, first or 0)
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == ids.tobytes()
        assert all(r["n_loss"] == sum(k >= bears for k in range(r["start"], r["start"] + r["length"])) for r in pieces)
    for pieces in by_seq.values():
        assert sum(r["length"] for r in pieces) <= limits.tokens and len(pieces) <= limits.segments and sum(r["n_loss"] for r in pieces) <= limits.loss
    if limits.loss == 40:
        assert max(sum(r["length"] for r in p) for p in by_seq.values()) > 200  # prompts take no share of the loss limit
        assert max(sum(r["n_loss"] for r in p) for p in by_seq.values()) == 40
    with pytest.raises(ValueError):
        pack_documents(d, "", limits=Limits(loss=0))


@pytest.mark.parametrize("limits", [Limits(), Limits(2048, 8, 500), Limits(256, 6, 40), Limits(64, 3, 100)])
@pytest.mark.parametrize("kind", ["tiny", "mixed", "edges"])
def test_packer_alone(limits, kind):
    rng = np.random.default_rng(2)
    tokens = {"tiny": np.full(1500, 3), "mixed": rng.lognormal(5, 1.5, 300).astype(int) + 1, "edges": np.array([0, 1, 2047, 2048, 2049, 5000])}[kind]
    first = (tokens * rng.random(len(tokens))).astype(int)
    by_doc, by_seq = {}, {}
    for e, s, n, q, o in pack(tokens, first, limits).tolist():
        by_doc.setdefault(e, []).append((s, n))
        by_seq.setdefault(q, []).append((o, n, max(0, s + n - max(s, first[e]))))
    for e, n in enumerate(tokens):
        at = 0
        for s, k in sorted(by_doc.get(e, [])):
            assert s == at and k > 0
            at += k
        assert at == n
    for pieces in by_seq.values():
        at = 0
        for o, n, _ in sorted(pieces):
            assert o == at
            at += n
        assert at == limits.tokens or at & (at - 1) == 0  # nothing to pad
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(k for *_, k in pieces) <= limits.loss


def brute_language_model(rows, fold, scored=2, deleted=3):
    """Scores from dictionaries of n-gram counts, with the same held-out cells and the fit under test."""
    tokens = [[w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in split(t)] + ["</s>"] for _, t in rows]

    def count(keep):
        c = {}
        for i, ws in enumerate(tokens):
            if keep(fold[i]):
                for k, w in enumerate(ws):
                    far, near = ws[k - 2] if k > 1 else "<s>", ws[k - 1] if k else "<s>"
                    for key in ((w,), (near, w), (far, near, w)):
                        c[key] = c.get(key, 0) + 1
                c["texts"] = c.get("texts", 0) + 1
        return c, sum(v for k, v in c.items() if len(k) == 1), sum(len(k) == 1 for k in c)

    def estimates(ws, c, n, v):
        for k, w in enumerate(ws):
            far, near = ws[k - 2] if k > 1 else "<s>", ws[k - 1] if k else "<s>"
            c1 = c.get((near,), 0) if k else c.get("texts", 0)
            c2 = c.get((far, near), 0) if k else c.get("texts", 0)
            level = lambda x: min(23, math.ceil(math.log2(x + 1)))
            yield (c.get((far, near, w), 0) / c2 if c2 else 0.0, c.get((near, w), 0) / c1 if c1 else 0.0, c.get((w,), 0) / n, 1 / (v + 1), 24 + level(c2) if c2 else level(c1))

    kept, every = count(lambda f: f not in (scored, deleted)), count(lambda f: f != scored)
    held = np.array([e for i, ws in enumerate(tokens) if fold[i] == deleted for e in estimates(ws, *kept)])
    cells, n = np.unique(lm_scoring.held_out_cells(*held[:, :3].T, held[0, 3], held[:, 4]), return_counts=True)
    weights = lm_scoring.fit_weights(cells, n)
    return tokens, every, [sum(math.log10(np.dot(weights[int(e[4])], e[:4])) for e in estimates(ws, *every)) for ws in tokens], (cells, n, weights)


def test_lm_scores(spark):
    rng = random.Random(21)
    words = [f"{'wW'[i % 2]}{i}" for i in range(60)]
    phrases = [" ".join(rng.choice(words) for _ in range(4)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(rng.randint(1, 25)))) for i in range(150)]
    rows += [(i + 200, rows[i][1]) for i in range(20)] + [(300, None), (301, ""), (302, "never seen words"), (None, "W1 w1 w2"), (303, "w3 " * 2000), (5, "w5")]
    fold = [0 if i is None else zlib.crc32(str(i).encode()) % 7 for i, _ in rows]
    tokens, (c, n, v), model, _ = brute_language_model(rows, fold)
    want = []
    for (i, _), ws, f, m in zip(rows, tokens, fold, model):
        base = sum(math.log10((c.get((w,), 0) + 1) / (n + v + 1)) for w in ws)
        want.append((i or -1, f == 2, len(ws), sum((w,) in c for w in ws), n, round(base, 6), round(m, 6)))
    d = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, block int, keys string").repartition(3)
    got = [(r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in score(d, fold_of(7), block_bytes=5000).collect()]
    assert sorted(got) == sorted(want)
    assert score(d.limit(0), fold_of(7)).count() == 0
    assert {r["score"] < 0 for r in score(d.limit(1), F.lit(2)).collect()} == {True}


def test_lm_scores_of_very_common_rows(spark):
    """Half of all rows are copies of three rows, in parts of their own: the same scores, a row each."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 20))), i % 7) for i in range(140)]
    rows += [(7, "w1 w2 W3 w4 " * 5, 0)] * 120 + [(7, "w1 w2 W3 w4 " * 5, 3)] * 90 + [(7, "w1 w2 W3 w4 " * 5, 2)] * 80 + [(None, "w9", 1)] * 60 + [(8, None, 3)] * 30
    rng.shuffle(rows)
    tokens, (c, n, v), model, _ = brute_language_model([r[:2] for r in rows], [f for *_, f in rows])
    want = sorted((i or -1, f == 2, len(ws), sum((w,) in c for w in ws), n, round(sum(math.log10((c.get((w,), 0) + 1) / (n + v + 1)) for w in ws), 6), round(m, 6)) for (i, _, f), ws, m in zip(rows, tokens, model))
    d = spark.createDataFrame(rows, "doc_id long, text string, fold int").repartition(3)
    plain = d.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lm_scoring._part_of(F.col("fold"), 2, 3).alias("part"))
    once, copies = lm_scoring._once(plain, 400)
    assert copies.count() == 290 and once.filter("twin is not null").agg(F.count("*"), F.sum("copies")).first()[:] == (3, 290) and once.filter("twin is null").count() == 230
    got = score(d, F.col("fold"), block_bytes=400).collect()
    assert sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == want


def test_lm_weights_and_counts():
    """No other weights make the held-out tokens likelier; counts of any size are kept."""
    rng = np.random.default_rng(3)
    p = [rng.random(500) * (rng.random(500) > 0.4) for _ in range(2)] + [rng.random(500) * 0.1 + 1e-3]
    cells, n = np.unique(lm_scoring.held_out_cells(*p, 1e-3, np.full(500, 30)), return_counts=True)
    w = lm_scoring.fit_weights(cells, n, rounds=500)[30]
    q = np.stack([np.where(x > 0, np.exp((x - 64.0) / lm_scoring.GRID), 0) for x in (cells >> 16 & 255, cells >> 8 & 255, cells & 255)] + [np.ones(len(cells))], axis=1)
    best = (n * np.log(q @ w)).sum()
    for _ in range(300):
        other = np.maximum(w + rng.normal(size=4) * 0.05, 1e-6)
        assert (n * np.log(q @ (other / other.sum()))).sum() <= best + 0.05
    counts = np.array([0, 1, 254, 255, 256, 2**32 + 5, 2**40])
    assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(counts), 7) == counts).all()


def test_decontamination(spark, docs):
    item = "Which river runs past the old mill at the edge of town before it meets the sea? The answer is the Grey Water."
    changed = item.replace("old mill", "ancient mill").replace("edge", "rim")
    rows = [(900, "w1 w2 w3 " * 20 + item + " w5 w6" * 30), (901, "w7 " * 50 + changed + " w9" * 10)]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    bench = spark.createDataFrame([(1, item), (2, None), (3, " ")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(more, bench).collect()} == {(900, 1), (901, 1)}
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0


def test_classifiers_on_odd_rows(spark, docs):
    rng = random.Random(1)
    en, de = ["the", "house", "with", "river", "and"], ["das", "haus", "mit", "fluss", "und"]
    rows = [(i, " ".join(rng.choice(de if i % 2 else en) for _ in range(12)), "de" if i % 2 else "en") for i in range(200)] + [(500, None, "en"), (501, "12 34", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(d, fold_of(5)).collect()}
    assert got[500][0] == got[501][0] == "und"
    assert sum(got[i][0] == lang for i, _, lang in rows[:200]) >= 195
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in quality_scores(d, labels, fold_of(5)).collect()}
    assert len(scores) == 202 and all(0 <= s <= 1 for s in scores.values())
    assert quality_scores(d.limit(0), labels, fold_of(5)).count() == 0


def test_url_filters(spark):
    pages = spark.createDataFrame([(1, "http://a.b.com/x/y", 5), (2, "http://b.com/", 1), (3, None, 5), (4, "bad", 5), (5, "http://A.b.com/x", 9)], "page_id long, url string, fetched_at int")
    events = spark.createDataFrame([("b.com", "add", 3), ("b.com", "remove", 7), ("a.b.com/x", "add", 4), (None, "add", 1), ("b.com", "add", 3)], "entry string, action string, at int")
    for most in (200_000, 0):
        got = {r["page_id"]: (r["n_active"], r["entry"], r["blocked"]) for r in match_captures(pages, events, broadcast_rows=most).collect()}
        assert got == {1: (2, "a.b.com/x", True), 2: (0, None, False), 3: (0, None, False), 4: (0, None, False), 5: (1, "a.b.com/x", True)}


def plain_words(text):
    marks = "".join(chr(c) for r in ((33, 48), (58, 65), (91, 97), (123, 127)) for c in range(*r))
    return [w.lower().strip(marks) or w.lower() for w in split(text)]


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_decontamination_of_paraphrases(spark, monkeypatch):
    """Items with up to a quarter of their words replaced, against the common subsequence of all pairs; many passes and slices."""
    monkeypatch.setattr(decontaminate, "PASS_ITEMS", 9)
    monkeypatch.setattr(decontaminate, "SLICE_ITEMS", 4)
    rng = random.Random(12)
    words = [f"{rng.choice('bcdfghk')}{rng.choice('aeiou')}{i}" for i in range(900)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [text(rng.randint(18, 40)) for _ in range(20)]
    rows, planted = [], set()
    for i in range(80):
        body = text(rng.randint(60, 200))
        if i % 2:
            k = rng.randrange(20)
            share, copy = rng.choice((0, 0.15, 0.22)), list(items[k])
            for at in rng.sample(range(len(copy)), int(share * len(copy))):
                copy[at] = rng.choice(words)
            at = rng.randrange(len(body))
            body[at:at] = copy
            planted.add((i, k))
        rows.append((i, " ".join(body).capitalize() + "."))
    rows += [(80, rows[1][1]), (None, rows[1][1]), (81, None), (82, "")]
    bench = [(k, " ".join(w)) for k, w in enumerate(items)] + [(50, " ".join(items[3])), (None, " ".join(items[3]))]
    found = contaminated(spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(1)), spark.createDataFrame(bench, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    want = set()
    for d, t in rows:
        for k, item in bench:
            if t and common_length(plain_words(item), plain_words(t)) >= 0.75 * len(item.split()):
                want.add((d, k))
    assert planted <= {(d, k) for d, k in want} and len(got & want) >= 0.97 * len(want)
    texts, itexts = dict(rows), dict(bench)
    for r in found:
        item, own = plain_words(itexts[r["item_id"]]), plain_words(texts[r["doc_id"]])
        share = common_length(item, own[r["start"] : r["end"]]) / len(item)
        assert r["covered"] == pytest.approx(share) and share >= 0.6


def test_decontamination_is_fitted_on_all_documents(spark, monkeypatch):
    """However few rows the start is made of, the latent space is that of all texts, long ones too."""
    rng = random.Random(5)
    words = [f"{rng.choice('bcdfghk')}{rng.choice('aeiou')}{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(120)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words[:25]))], "item_id long, text string")
    frequency = decontaminate.document_frequencies(docs)
    idf = np.log((1.0 + 120) / (1.0 + frequency[:-1])) + 0.05
    weighed = lambda df: df.select("text", F.lit(1.0).alias("weight"))
    spaces = [decontaminate.latent_space(weighed(s), docs, bench, idf, 10.0) for s in (docs, docs.filter("doc_id % 3 > 0"))]
    # Inner products of passages, which are all that is used, don't hang on the sample.
    data, offsets = decontaminate.text_bytes(pa.array([r["text"] for r in docs.orderBy("doc_id").limit(30).collect()], pa.large_string()))
    terms, doc, _ = decontaminate.words_of(data, offsets)
    cosines = [v @ v.T for v, _, _ in (decontaminate._project(terms, doc, 30, s) for s in spaces)]
    assert np.abs(cosines[0] - cosines[1]).mean() < 0.05
    read = []
    known = decontaminate._summed
    monkeypatch.setattr(decontaminate, "_summed", lambda df, *a: read.append(df.count()) or known(df, *a))
    monkeypatch.setattr(decontaminate, "FIT_DOCS", 20)
    monkeypatch.setattr(decontaminate, "FIT_BYTES", 100)
    contaminated(docs, bench).count()
    assert read.count(120) >= 2


def test_sums_and_holders_of_terms():
    """Rare and frequent terms, in tables of one row or many, and texts with flags or without, give plain sums and counts."""
    rng = np.random.default_rng(3)
    for n, halves, kinds in ((1, 1, 5), (5000, 40, 300), (3000, 900, 7)):
        terms = np.sort(rng.zipf(1.3, n) % kinds) * 50
        half = np.sort(rng.integers(0, halves, n))
        back = rng.normal(size=(halves, 8)).astype(np.float32)
        want = np.zeros((decontaminate.TERMS, 8))
        np.add.at(want, terms, back[half].astype(float))
        for table in (1, 1 << 20):
            decontaminate.TABLE, before = table, decontaminate.TABLE
            held, sums = decontaminate._term_sums(terms, half, back)
            decontaminate.TABLE = before
            assert held.tolist() == sorted(set(terms.tolist())) and np.allclose(sums, want[held], atol=1e-2)
        for docs in (halves, decontaminate.FLAGGED + halves):
            got = decontaminate._holders(terms, half, docs)
            assert got.sum() == len(set(zip(terms.tolist(), half.tolist()))) and got[held].tolist() == [len(set(half[terms == t].tolist())) for t in held]
