"""Importance resampling against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefolio.llm import resample
from tablefolio.llm.queries import QUERIES
from tablefolio.plans.catalogue import table


def plain_features(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = chr(ord(c) + 32)
        if c >= "\x80" or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        else:
            words, word = words + [word] if word else words, ""
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(rows, target, percent=25, least_words=20, seed=7):
    def hashed(text):
        return Counter(zlib.crc32(f.encode()) % 10000 for f in plain_features(text)[1])

    s, t = sum((hashed(x) for _, x in rows), Counter()), sum((hashed(x) for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out, pool = {}, []
    for at, (i, text) in enumerate(rows):
        words, features = plain_features(text)
        weight = sum(gain[b] * n for b, n in hashed(text).items()) // len(features) if features else 0
        if i is None:
            out[at] = (i, len(features), weight, None, None)
            continue
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[at] = (i, len(features), weight, score, None)
        if len(words) >= least_words:
            pool.append((-score, i, at))
    for rank, (_, _, at) in enumerate(sorted(pool)[:percent * len(pool) // 100], 1):
        out[at] = (*out[at][:4], rank)
    return Counter(out.values())


def corpus(n=160):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "ß1", "x-y", "don't", "A", "a", "\x80", "\x7f", "ünd", "\x00"]
    texts = [None, "", " .,", "one", "one two", "x " * 19, "x " * 20, "X,x " * 10, "long" * 400]
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(15, 80))) for _ in range(n)]
    target = [" ".join(rng.choices(vocabulary[:20], k=30)) for _ in range(10)] + [None, "", "W1 w2"]
    return texts, target


@pytest.mark.parametrize(("percent", "pivots", "range_rows"), [(25, 31, 200_000), (60, 1, 7), (100, 3, 10), (1, 2, 1)])
def test_as_plain(odd, percent, pivots, range_rows):
    texts, target = corpus()
    rows = list(enumerate(texts, 10))
    got = resample.resample(odd(texts, [i for i, _ in rows]), odd(target), percent=percent, pivots=pivots, range_rows=range_rows)
    assert Counter(map(tuple, got.collect())) == brute(rows, target, percent)


def test_long_text_in_pieces():
    texts, _ = corpus()
    text = " ".join(t for t in texts if t)
    want = Counter(zlib.crc32(f.encode()) % 10000 for f in plain_features(text)[1])
    for piece in (1, 10, 333, 1 << 20):
        found = np.concatenate(list(resample.buckets(text.encode(), piece)))
        assert Counter(found.tolist()) == want


def test_every_key_is_found(spark):
    rng = random.Random(6)
    keys = [(rng.randint(0, 5), rng.randint(0, 3), i) for i in range(90)]
    df = spark.createDataFrame(keys, "a long, b long, c long")
    for k in (1, 2, 44, 89, 90):
        assert resample.kth_key(df, ["a", "b", "c"], k, 4) == sorted(keys)[k - 1]
    with pytest.raises(ValueError, match="fewer rows"):
        resample.kth_key(df, ["a", "b", "c"], 91, 4)


def test_ties_repeats_and_rows_without_id(odd):
    """Equal ids and texts give equal scores; each such row is drawn and ranked by itself."""
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(3, text)] * 9 + [(None, text)] * 3 + [(4, text), (5, "short")]
    got = resample.resample(odd([t for _, t in rows], [i for i, _ in rows]), odd([text]), percent=50)
    assert Counter(map(tuple, got.collect())) == brute(rows, [text], 50)


def test_empty_tables(odd):
    assert resample.resample(odd([]), odd(["a b"])).collect() == []
    rows = [(i, "a b c " * 10) for i in range(8)]
    got = resample.resample(odd([t for _, t in rows]), odd([])).collect()
    assert Counter(map(tuple, got)) == brute(rows, [])


def test_names_that_clash(odd):
    df = odd(["a b c " * 10] * 4)
    for name in ("below", "score", "rank", "weight", "part", "start", "bucket", "n_words", "__id"):
        df = df.withColumn(name, F.lit("x"))
    assert [r["rank"] for r in resample.resample(df, odd(["a"])).collect() if r["rank"]] == [1]


def test_query_as_plain(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in table(spark, sf, "benchmark").collect()]
    got = QUERIES["op12_importance_sample"].run(spark, sf)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 5
    assert Counter(map(tuple, got.collect())) == brute(rows, target)
