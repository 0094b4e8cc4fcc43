"""Stages of the pipeline decide row by row, whatever the ids."""

import random

import pytest

import corpus_pipeline as cp

ITEM = "Which river runs past the old mill at the edge of town before it meets the sea? The answer is the Grey Water."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def some(rng, n):
    return " ".join(f"w{rng.randint(1, 400)}" for _ in range(n))


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def texts(df):
    assert tuple(df.columns) == cp.COLUMNS
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "", r["lang"], r["n_chars"]) for r in df.collect())


def want(rows):
    return sorted((-1 if i is None else i, t or "", "en", len(t or "")) for i, t in rows)


def test_decontamination_by_row(spark, frame, tmp_path):
    rng = random.Random(1)
    clean = [(None, some(rng, 90)), (None, None), (None, some(rng, 70)), (4, some(rng, 80)), (5, some(rng, 80)), (6, None), *((i, some(rng, 60)) for i in range(10, 60))]
    bad = [(None, some(rng, 30) + " " + ITEM + " " + some(rng, 30)), (4, some(rng, 50) + " " + ITEM)]
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert texts(cp.decontamination(spark, frame(clean + bad), str(tmp_path))) == want(clean)
    spark.createDataFrame([], "item_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "benchmark.parquet"))
    assert texts(cp.decontamination(spark, frame(clean + bad), str(tmp_path))) == want(clean + bad)


def test_quality_by_row(spark, frame, tmp_path):
    rng = random.Random(2)
    good = lambda: "The " + " ".join(rng.choice(("house", "river", "stands", "near", "a", "quiet", "town")) for _ in range(40)) + "."
    junk = lambda: " ".join("$%#@" + str(rng.randint(1000, 9999)) for _ in range(40))
    known = [(i, junk() if i % 2 else good()) for i in range(200)]
    kept, gone = [(None, good()), (900, good())], [(None, junk()), (900, junk())]
    spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = texts(cp.quality(spark, frame(known + kept + gone), str(tmp_path)))
    assert [r for r in got if r[0] in (-1, 900)] == want(kept)


def test_near_dedup_by_row(spark, frame, tmp_path):
    rng = random.Random(3)
    base, other = some(rng, 80).split(), some(rng, 80)
    near = " ".join([*base[:40], "changed", *base[41:]])
    base = " ".join(base)
    alone = some(rng, 60)
    stay = [(2, base), (5, some(rng, 60)), (5, alone), (None, some(rng, 60)), (None, other), (None, None), (None, ""), (None, None), (8, None), (9, " ")]
    fall = [(7, near), (None, near), (None, base), (5, base), (5, alone), (None, other)]
    assert texts(cp.near_dedup(spark, frame(stay + fall), str(tmp_path))) == want(stay)


def odd(rng):
    """Nulls, blanks, ties, repeated rows, a text of 60,000 words."""
    passage = some(rng, 30)
    rows = [(i, some(rng, 60)) for i in range(20)] + [(30, passage + " " + some(rng, 40)), (31, some(rng, 40) + " " + passage), (32, passage)]
    return rows + [(None, some(rng, 50)), (None, None), (33, ""), (33, ""), (34, "one"), (35, some(rng, 60000)), (20, some(rng, 30)), (20, some(rng, 30))]


def with_more(spark, rows):
    """Columns whose names the stages use themselves."""
    more = "id int, row string, digest int, block string, other_id int, score string, place int, key string, component_id int, sequence_id string"
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0, "r", 1, "b", 2, "s", 3, "k", 4, "q") for i, t in rows], SCHEMA + ", " + more).repartition(3)


def tables(spark, path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_substring_dedup_brute_force(spark, tmp_path):
    rows = odd(random.Random(5))
    got = cp.substring_dedup(spark, with_more(spark, rows), str(tmp_path))
    assert tuple(got.columns) == cp.COLUMNS
    order, seen, out = sorted((r for r in rows if r[0] is not None and r[0] != 20), key=lambda r: r[0]), set(), []
    for i, t in [r for r in rows if r[0] is None] + order:
        words, gone = (t or "").split(), set()
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone) if gone else t
        out.append((-1 if i is None else i, kept or "", "en", len(kept or "")))
    assert [r for r in texts(got) if r[0] != 20] == sorted(out)
    assert [r[0] for r in out if len(r[1].split()) == 40] == [31] and (32, "", "en", 0) in out


def test_packing_brute_force(spark, tmp_path):
    """Pieces give back each text's ids once, in order, and fill sequences without gaps."""
    import zlib
    from collections import Counter, defaultdict

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = odd(random.Random(6))
    got = cp.packing(spark, with_more(spark, rows), str(tmp_path)).collect()
    bpe = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    crc, seqs = Counter(), defaultdict(list)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*bpe.encode(t or "", add_special_tokens=False).ids, 1])
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        fits = [x for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"] and zlib.crc32(np.array(x[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]]
        assert fits
        crc[r["doc_id"]] += r["length"]
    assert crc == Counter({i: sum(map(len, x)) for i, x in ids.items()})
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_all_stages_on_odd_and_empty_tables(spark, tmp_path):
    tables(spark, tmp_path)
    rows = odd(random.Random(7))
    for docs in (with_more(spark, rows), with_more(spark, rows[:0])):
        n = docs.count()
        for name, stage in cp.STAGES:
            got = stage(spark, docs, str(tmp_path))
            assert name == "packing" or tuple(got.columns) == cp.COLUMNS
            assert got.count() <= n or name == "packing"
            if not n:
                assert got.count() == 0


def test_run_is_its_stages(spark, frame, tmp_path):
    tables(spark, tmp_path)
    rows = odd(random.Random(8)) + [(50, some(random.Random(9), 40) + " " + ITEM)]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in cp.STAGES[:-1]:
        docs = frame([(r["doc_id"], r["text"]) for r in stage(spark, docs, str(tmp_path)).collect()])
    want_tokens = cp.packing(spark, docs, str(tmp_path)).groupBy("doc_id", "doc_tokens").count().collect()
    got = cp.run(spark, str(tmp_path))
    key = lambda rows: sorted((-1 if r["doc_id"] is None else r["doc_id"], r["doc_tokens"]) for r in rows)
    assert key(got.groupBy("doc_id", "doc_tokens").count().collect()) == key(want_tokens)
    assert 50 not in {r["doc_id"] for r in got.collect()} and got.count() > 0
