"""Divergence audit, exact search and importance resampling against brute force, with odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cytospark.llm import cover_tree, divergence_audit
from cytospark.llm.cover_tree import CoverTree, Search, top_k
from cytospark.llm.divergence_audit import divergence
from cytospark.llm.resampling import resample
from cytospark.operators.numbering import numbered
from pyspark.sql import functions as F

LOWER = {c: c + 32 for c in range(65, 91)}


def texts():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    out = []
    for i in range(160):
        text = " ".join(words[int(x)] for x in np.minimum(rng.zipf(1.3, rng.integers(1, 60)), 144) - 1)
        out.append((i, text, ["en", "de"][i % 2], f"s{i % 5}"))
    out += [(200, None, "en", "s1"), (201, "", None, None), (202, "12 34 -- \x00", "en", "only digits"), (203, "Été ÉTÉ ÄB c x\U0001f600y", "fr", "s0")]
    out += [(204, "lone words here", "xx", "a"), (205, "lone words here", "xx", "b"), (None, "lone Words", "xx", "b"), (7, "wab " * 30, "en", "s0"), (7, "wab " * 30, "en", "s0")]
    out += [(206, "wab wac " * 4000, "de", "s1"), (207, "once", "yy", "z")]
    return out


SCHEMA = "doc_id long, text string, lang string, source string, term int, rank string, n string, x int, row int, tile int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, "a", "b", 1, 2, 3) for r in texts()], SCHEMA).repartition(3).cache()


def audit(rows, least=3, top=200):
    rows = [(t or "", lang or "", s or "") for _, t, lang, s in rows]
    terms = [(Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(LOWER))), lang, s) for t, lang, s in rows]
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for c, lang, s in terms:
        groups[lang].add(s)
        df[lang].update(c.keys())
        n[lang, s].update(c)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in df[lang].items() if d >= least]
        total = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (n[lang, s][t] + 1) // (total[s] + len(kept)) for t in kept} for s in sources}
        whole = {t: 1 + 10**9 * (sum(n[lang, s][t] for s in sources) + 1) // (sum(total.values()) + len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            favoured = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if n[lang, s][t] and p[s][t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", favoured, top)):
                for r, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, v, r))
    return sorted(out)


@pytest.mark.parametrize("cells, chunk", [(1 << 21, 8 << 20), (7, 300)])
def test_divergence(docs, cells, chunk):
    """Also with tables of pairs that are cut into tiles and chunks of few documents."""
    got = divergence(docs, cells=cells, chunk_bytes=chunk).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == audit(texts())


def test_divergence_scan_over_small_batches(docs, spark):
    """Runs of a term go on over many batches of the sorted stream."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = divergence(docs, top=3).select("lang", "source", "part", "item", "value", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == audit(texts(), top=3)


def test_divergence_limits(docs, spark, monkeypatch):
    assert divergence(docs.limit(0)).count() == 0
    monkeypatch.setattr(divergence_audit, "MOST_GROUPS", 3)
    with pytest.raises(ValueError, match="groups"):
        divergence(docs)
    big = np.array([0, 9 * 10**14, 9 * 10**15 - 1])
    assert divergence_audit._share(big, np.array([9 * 10**15] * 3)).tolist() == [1 + 10**9 * int(x) // (9 * 10**15) for x in big]


def ranks(rows, every=3, k=4):
    usable = [(i, n, [math.floor(1024 * float(np.float32(c))) for c in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, n, v in usable:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in usable if m != n)[:k]
            out += [(i, r, j, -s) for r, (s, j, _) in enumerate(scored, 1)]
    return sorted(out)


def vectors(n=900):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + 0.1 * rng.normal(size=8)).tolist()) for i in range(n)]
    rows += [(n + i, [0.5] * 8) for i in range(400)]
    return rows + [(3, [0.25] * 8), (3, [0.25] * 8), (None, [1.0] * 8), (9000, None), (9001, [1.0, None] * 4), (9003, [float("nan")] * 8), (9006, [float("inf")] * 8), (9009, [0.0] * 8), (9012, []), (9015, [2.0, -1.0])]


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, monkeypatch, small):
    """Clusters, 400 equal vectors, repeated ids and unusable rows; also with many pivots, blocks and groups."""
    if small:
        for name, value in {"PER_PIVOT": 60, "LEAST_ROWS": 20, "GROUP_ROWS": 16, "TASK_QUERIES": 100}.items():
            monkeypatch.setattr(cover_tree, name, value)
    rows = vectors()
    table = spark.createDataFrame([(i, v, 0, "q", 1) for i, v in rows], "vec_id long, embedding array<float>, row int, cell string, score int").repartition(3)
    got = top_k(table, F.col("vec_id") % 3 == 0, k=4)
    assert sorted(map(tuple, got.collect())) == ranks(rows)


def test_top_k_sends_no_trees_through_the_driver(spark, monkeypatch):
    """However small Spark takes them to be: no broadcast holds query trees or blocks."""
    monkeypatch.setattr(cover_tree, "PER_PIVOT", 100)
    table = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        got = top_k(table, F.col("vec_id") % 3 == 0, k=4)
        assert got.count()
        plan = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "tree#" in plan
    assert not [part for part in plan.split("\n\n") if "BroadcastExchange\n" in part and "tree#" in part]


def test_top_k_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(3, [1.0])], [(1, [1.0]), (2, [2.0])], [(3, None)]):
        assert top_k(spark.createDataFrame(rows, schema), F.col("vec_id") % 3 == 0).count() == 0
    few = top_k(spark.createDataFrame([(0, [1.0]), (5, [2.0]), (4, [2.0])], schema), F.col("vec_id") == 0)
    assert sorted(map(tuple, few.collect())) == [(0, 1, 4, 2 << 20), (0, 2, 5, 2 << 20)]
    with pytest.raises(ArithmeticError):
        top_k(spark.createDataFrame([(0, [1e30, 1.0])], schema), F.lit(True))


def test_tree_covers_and_separates_and_prunes():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * (np.repeat(rng.normal(size=(20, 5)), 200, axis=0) + 0.01 * rng.normal(size=(4000, 5)))).astype(np.int64)
    tree = CoverTree.unpack(CoverTree(x, np.arange(4000), np.arange(4000)).pack())
    for n in range(len(tree.lo)):
        d = np.sqrt(((tree.x[tree.lo[n] : tree.hi[n]] - tree.x[tree.centre[n]]) ** 2).sum(axis=1))
        assert d.max() <= tree.radius[n]
        kids = tree.x[tree.centre[tree.first[n] : tree.last[n]]].astype(float)
        if len(kids) > 1:
            assert [tree.lo[n], tree.hi[n]] == [tree.lo[tree.first[n]], tree.hi[tree.last[n] - 1]]
            apart = np.sqrt(((kids[:, None] - kids[None]) ** 2).sum(axis=2))[~np.eye(len(kids), dtype=bool)].min()
            assert apart >= tree.radius[tree.first[n] : tree.last[n]].max() * (1 - 1e-9)
    queries = CoverTree(x[:100], np.arange(100), np.arange(100))
    done = []
    original = Search._score
    Search._score = lambda self, a, leaves: (done.append(int((self.d.hi[leaves] - self.d.lo[leaves]).sum() * (self.q.hi[a] - self.q.lo[a]))), original(self, a, leaves))[1]
    try:
        got = Search(queries, tree, 5, np.full(100, -np.inf)).found()
    finally:
        Search._score = original
    assert sum(done) < 0.25 * 100 * 4000
    scores = x[:100] @ x.T
    scores[np.arange(100), np.arange(100)] = np.iinfo(np.int64).min
    assert sorted(got["score"].to_pylist()) == sorted(np.sort(scores, axis=1)[:, -5:].ravel().tolist())


def draw(rows, target, percent, least, longest=1, buckets=10000):
    def features(t):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    docs, aim = [features(t) for _, t in rows], [features(t)[1] for t in target]
    s, t = Counter(b for _, f in docs for b in f), Counter(b for f in aim for b in f)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for (i, _), (n, f) in zip(rows, docs):
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    order = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    place = {id(r): k for k, r in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted(((*r[:4], place.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resample(docs, spark, longest):
    target = ["wab wac waa", None, "", "Été 12", "WAB unseen"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resample(docs, table, 30, least_words=5, longest=longest).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == draw([r[:2] for r in texts()], target, 30, 5, longest)


def test_resample_odd_tables(docs, spark):
    target = spark.createDataFrame([], "text string")
    assert resample(docs.limit(0), target).count() == 0
    got = resample(docs, target, least_words=1, percent=100, carry=("text", "term"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "text", "term"]
    assert sorted(r["rank"] for r in got.filter("rank is not null").collect()) == list(range(1, sum(len(re.findall("[0-9A-Za-z\x80-\U0010ffff]+", r[1] or "")) > 0 for r in texts()) + 1))
    assert resample(docs, target, percent=0).filter("rank is not null").count() == 0


def test_numbered(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("a"), "id").repartition(5)
    got = numbered(rows, [F.desc("a"), F.asc("id")], "k", 1).orderBy("k").collect()
    assert [r["k"] for r in got] == list(range(1, 1001))
    assert [(r["a"], r["id"]) for r in got] == sorted([(i % 7, i) for i in range(1000)], key=lambda x: (-x[0], x[1]))
    assert numbered(rows.limit(0), [F.asc("id")]).count() == 0
