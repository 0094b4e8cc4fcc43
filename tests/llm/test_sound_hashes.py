"""Words that a polynomial hash can't tell apart, samples of huge tables, hosts of odd URLs."""

import datetime as dt

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cytospark.llm import language_crf
from cytospark.llm.blocks import drawn
from cytospark.llm.near_dedup import near_duplicates
from cytospark.llm.substring_dedup import remove_repeats
from cytospark.llm.textkit import span_hashes
from cytospark.llm.tokenise import UnitEncoder
from cytospark.llm.url_filters import match_captures, url_host


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


PAIR = thue_morse(2048, "ab"), thue_morse(2048, "ba")


def test_spans():
    words = [b"", b"a", b"ab", b"ba", b"x" * 8, b"x" * 9, b"y" * 64, b"y" * 65, PAIR[0].encode(), PAIR[1].encode(), b"Ab"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    plain = span_hashes(data, starts, ends)
    assert len(set(plain.tolist())) == len(words) and not set(plain.tolist()) & set(span_hashes(data, starts, ends, seed=2).tolist())
    folded = span_hashes(data, starts, ends, fold=True)
    assert folded[2] == folded[-1] == plain[2]
    again = span_hashes(np.frombuffer(b"...." + PAIR[1].encode(), np.uint8), np.array([4]), np.array([2052]))
    assert again[0] == plain[9]


def test_substring_dedup_and_near_dedup(spark):
    rest = [f"w{i}" for i in range(19)]
    docs = spark.createDataFrame([(1, " ".join([PAIR[0], *rest])), (2, " ".join([PAIR[1], *rest])), (3, PAIR[0]), (4, PAIR[1])], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    alone = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs.filter("doc_id > 2")).collect()}
    assert alone == {3: 3, 4: 4}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids(name, monkeypatch):
    """Also where every hash is the same, so that only the bytes tell units apart."""
    texts = [f"one {PAIR[0]} two", f"one {PAIR[1]} two", "three, four. three", "Straße <|x|> a  b", ""]
    path = public_tokenizers.path(name)
    whole = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])]
    for clash in (False, True):
        if clash:
            monkeypatch.setattr("cytospark.llm.tokenise.span_hashes", lambda data, s, e, seed: (e - s).astype(np.uint64) // np.uint64(3))
        bpe = UnitEncoder(path)
        for _ in range(2):
            ids, ends = bpe.encode(data, offsets)
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == whole


def test_draws_of_huge_tables(spark):
    rows = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    assert rows.filter(drawn(F.col("h"), 10, 5)).count() == 200_000
    assert 800 < rows.filter(drawn(F.col("h"), 1000, 200_000)).count() < 1200
    least = drawn(F.lit(-(1 << 63)).cast("long"), 250, 1e15)
    assert spark.range(1).select(least.alias("x")).first()["x"]


def test_training_sample_of_many_rows(spark):
    """With the counts of a huge table, a share of the rows is still drawn; copies and rare languages are bounded."""
    n = 30_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang")).withColumn("draw", F.xxhash64("doc_id", "text", F.lit(5)))
    texts, _ = language_crf._pick(docs, F.lit(0), {"en": int(1e10)}, int(1e8), 100)
    assert 250 < len(texts) < 480
    same = spark.range(5000).select(F.lit(7).alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.concat(F.lit("l"), F.col("id") % 20).alias("lang"))
    texts, labels = language_crf.training_sample(same.unionByName(other), most=10**6, languages=5)
    assert sorted(labels) == ["en", "l0", "l0", "l1", "l1", "l10", "l10", "l11", "l11"]


def hosts():
    return {
        "http://user:pw@evil.com/x": "evil.com", "http://user@evil.com/x": "evil.com", "http://a@b@evil.com": "evil.com", "HTTP://EVIL.com./X": "evil.com", "https://evil.com:8443?q": "evil.com",
        "http://[::1]:80/x": "[::1]", "http://u@[2001:DB8::1]/": "[2001:db8::1]", "http://evil.com\\@good.com/": "evil.com", "http://good.com/@evil.com": "good.com", "http://good.com?u=@evil.com": "good.com", "evil.com/x": None, "http:///x": None, None: None, "": None, " http://evil.com/x": "evil.com",
    }


def test_hosts(spark):
    rows = spark.createDataFrame([(k,) for k in hosts()], "url string").select("url", url_host(F.col("url")).alias("host")).collect()
    assert {r["url"]: r["host"] for r in rows} == hosts()


def test_blocked_whatever_the_user_name(spark):
    day = dt.date(2024, 1, 2)
    urls = ["http://user:pw@evil.com/x", "http://SUB.Evil.com.:80/Path/a", "http://good.com/Path/a", "http://good.com/path/a", None, "http://good.com/Path/a"]
    captures = spark.createDataFrame([(i // 2, u, day, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, fetched_at date, entry string, host string")
    events = spark.createDataFrame([("EVIL.com.", "add", dt.date(2024, 1, 1)), ("good.com/Path", "add", day)], "entry string, action string, at date")
    for most in (200_000, 0):
        got = match_captures(captures, events, broadcast_rows=most)
        assert sorted((r["page_id"], r["entry"] or "", r["n_active"]) for r in got.collect()) == [(0, "evil.com", 1), (0, "evil.com", 1), (1, "", 0), (1, "good.com/Path", 1), (2, "", 0), (2, "good.com/Path", 1)]
        assert match_captures(captures.limit(0), events, broadcast_rows=most).count() == 0
        assert match_captures(captures, events.limit(0), broadcast_rows=most).filter("blocked").count() == 0
