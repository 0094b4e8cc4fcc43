"""The two classifiers against their definitions, on odd rows, and on held-out documents."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytospark.llm import quality as ql
from cytospark.llm.language_crf import identify, posteriors
from cytospark.llm.quality import document_statistics, fit, isotonic, quality_scores
from cytospark.llm.queries import QUERIES
from cytospark.llm.textkit import text_bytes

SF = "/root/testdata/sf0.01"


def fold_of(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@pytest.mark.parametrize("lengths", [(1, 4, 2), (5,), (3, 0, 3)])
def test_posteriors_by_enumeration(lengths):
    rng = np.random.default_rng(sum(lengths))
    emission, transition = rng.normal(size=(sum(lengths), 3)), rng.normal(size=(3, 3))
    doc = np.repeat(np.arange(len(lengths)), lengths)
    got = posteriors(emission, doc, len(lengths), transition)
    for d in range(len(lengths)):
        rows = np.flatnonzero(doc == d)
        want = np.zeros((len(rows), 3))
        for path in itertools.product(range(3), repeat=len(rows)):
            score = sum(emission[r, y] for r, y in zip(rows, path)) + sum(transition[a, b] for a, b in zip(path, path[1:]))
            for t, y in enumerate(path):
                want[t, y] += np.exp(score)
        if len(rows):
            assert np.allclose(got[rows], want / want.sum(axis=1, keepdims=True), atol=1e-5)


def test_posteriors_of_a_long_chain():
    """Blocks of words give what one recursion over all words gives."""
    rng = np.random.default_rng(1)
    e, a = rng.normal(size=(501, 4)), rng.normal(size=(4, 4))
    x, m = np.exp(e), np.exp(a)
    forward, backward = [x[0] / x[0].sum()], [np.ones(4)]
    for t in range(1, 501):
        v = (forward[-1] @ m) * x[t]
        forward.append(v / v.sum())
        w = m @ (x[501 - t] * backward[-1])
        backward.append(w / w.sum())
    want = np.array(forward) * np.array(backward[::-1])
    assert np.allclose(posteriors(e, np.zeros(501, int), 1, a), want / want.sum(axis=1, keepdims=True), atol=1e-4)


def test_language_of_odd_rows_and_switches(spark):
    rng = random.Random(1)
    words = {"en": ["the", "house", "with", "river", "and", "stone"], "de": ["das", "haus", "mit", "fluss", "und", "straße"]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text("de" if i % 2 else "en", 14), "de" if i % 2 else "en") for i in range(200)]
    mixed = text("en", 30) + " " + text("de", 50)
    odd = [(500, None, "en"), (501, "12 34 !", None), (502, "", None), (503, mixed, None), (504, text("de", 30000), None), (None, text("en", 9), None), (7, rows[7][1], "de"), (505, "\x0b \t", "fr")]
    d = spark.createDataFrame([(*r, "k", 1.0) for r in rows + odd], "doc_id long, text string, lang string, lang_pred string, score double").repartition(3)
    out = identify(d, fold_of(5)).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r["doc_id"]: r for r in out}
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503, 504, None, 7, 505)] == ["und", "und", "und", "de", "de", "en", "de", "und"]
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in rows) == 200 and all(0 <= r["score"] <= 1 for r in out)
    runs = [(r["lang"], r["end"] - r["start"]) for r in got[503]["runs"]]
    assert sum(n for _, n in runs) == 80 and abs(sum(n for lang, n in runs if lang == "en") - 30) <= 2
    assert identify(d.limit(0), fold_of(5)).count() == 0
    assert {(r["lang_pred"], r["score"]) for r in identify(d.withColumn("lang", F.lit(None).cast("string")), fold_of(5)).collect()} == {("und", 0.0)}


def test_long_texts_alone_teach_a_language(spark):
    rows = [(i, " ".join(["pa", "lo", "mi"] * 6000) if i % 2 else "ku ze to", "xx" if i % 2 else "yy") for i in range(40)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2), fold_of(5)).collect()
    assert all(r["lang_pred"] == ("xx" if r["doc_id"] % 2 else "yy") for r in got)


def test_isotonic_by_all_means():
    """The fit at a place is the greatest least mean of the runs that hold it."""
    rng = np.random.default_rng(2)
    p, n = rng.integers(0, 6, 30).astype(float), rng.integers(5, 9, 30).astype(float)
    mean = lambda i, j: p[i : j + 1].sum() / n[i : j + 1].sum()
    want = [max(min(mean(i, j) for j in range(k, 30)) for i in range(k + 1)) for k in range(30)]
    assert np.allclose(isotonic(np.arange(30.0), p, n), want)


def test_ridge_by_normal_equations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, ql.STATISTICS)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(float)
    rows = [(int(i % 5), [float(v) for v in x[i]], float(y[i])) for i in range(300)]
    model = fit(spark.createDataFrame(rows, "fold int, x array<float>, y double").repartition(4))
    own = np.arange(300) % 5 != 4
    phi = model.features(x.astype(float))
    a = phi[own].T @ phi[own] / own.sum() + ql.RIDGE * np.eye(phi.shape[1])
    assert np.allclose(model.weight, np.linalg.solve(a, phi[own].T @ y[own] / own.sum()), atol=1e-6)
    assert np.allclose(model.mean, x[own].mean(axis=0), atol=1e-5) and (np.diff(model.chance) >= 0).all()
    # Inner products of the random features stand for a Gaussian kernel.
    z = np.clip((x[:60] - model.mean) / model.scale, -6, 6)
    near = phi[:60, 1 + ql.STATISTICS :] @ phi[:60, 1 + ql.STATISTICS :].T * 2 / ql.FOURIER
    gap = ((z[:, None] - z[None]) ** 2).sum(axis=2)
    assert np.abs(near - np.exp(-gap / (4 * ql.STATISTICS * ql.WIDTH**2))).max() < 0.35


def test_quality_of_odd_rows_and_labels(spark):
    rng = random.Random(5)
    good = lambda: "The " + " ".join(rng.choice(("house", "river", "stands", "near", "a", "quiet", "town")) for _ in range(40)) + "."
    junk = lambda: " ".join("$%#@" + str(rng.randint(1000, 9999)) for _ in range(40))
    rows = [(i, junk() if i % 2 else good()) for i in range(200)] + [(None, good()), (300, None), (301, ""), (302, "a b " * 40000), (4, good())]
    d = spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, score double, fold string").repartition(3)
    labels = [(i, 1 - i % 2) for i in range(200)] + [(None, 1), (3, None), (5, 0), (5, 0), (999, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    out = quality_scores(d, labels, fold_of(5), carry=("score", "fold")).collect()
    assert len(out) == len(rows) and all(0 <= r[2] <= 1 for r in out) and {(r[3], r[4]) for r in out} == {(0.5, "x")}
    got = {r[0]: r[2] for r in out}
    assert all((got[i] > 0.5) == (i % 2 == 0) for i in range(200)) and got[None] > 0.5
    assert {r["score"] for r in quality_scores(d.drop("score"), labels.limit(0), fold_of(5)).collect()} == {0.5}
    assert quality_scores(d.limit(0), labels, fold_of(5)).count() == 0


def test_statistics_do_not_depend_on_batches(spark):
    texts = ["", "One, two. THREE!\n" * 9, "x" * 5000, "a b c", "é ü 12 34 " * 30]
    import pyarrow as pa

    together = document_statistics(*text_bytes(pa.array(texts)))
    alone = np.concatenate([document_statistics(*text_bytes(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op7_language_id"](spark, SF).filter("held_out and lang_pred <> 'und'").join(truth.filter("lang is not null"), "doc_id").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality is not null")
    rows = QUERIES["op8_quality"](spark, SF).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 40 and np.mean([r["quality"] == r["predicted"] for r in rows]) >= 0.95
