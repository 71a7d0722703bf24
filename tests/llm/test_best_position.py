"""Ranked search against plain Python over all documents."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablefolio.llm import best_position
from tablefolio.llm.best_position import ImpactLists


def plain_terms(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c >= "\x80" or "0" <= c <= "9" or "a" <= c <= "z" or "A" <= c <= "Z":
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
        else:
            words, word = words + [word] if word else words, ""
    return words


def brute(rows, items, k=10):
    docs = [(i, at, Counter(plain_terms(t))) for at, (i, t) in enumerate(rows)]
    n, length = sum(bool(c) for *_, c in docs), sum(c.total() for *_, c in docs)
    df = Counter(t for *_, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, at, c in docs:
            score = 0
            for t in plain_terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (25 + 75 * c.total() * n // length)))
            if score > 0:
                found.append((-score, i is None, i or 0, at, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return Counter(out)


def corpus(n=150):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(80)]
    rank = [1 / (k + 1) for k in range(80)]
    texts = [None, "", " .;", "W1", "É w1", "w1-w2_w3", "w1 " * 500, "x\x7fy w5", "w3\x00w4"]
    texts += [" ".join(rng.choices(vocabulary, rank, k=rng.randint(1, 60))) for _ in range(n)]
    texts += [texts[20]] * 15 + [texts[30].upper()] * 12  # ties
    items = [(j, " ".join(rng.choices(vocabulary, k=rng.randint(1, 9)))) for j in range(12)]
    items += [(50, None), (51, ""), (52, "unheard of"), (53, "w1"), (54, texts[20]), (55, "w2 w2 W2 w9"), (55, "w3"), (56, "é")]
    return texts, items


def item_table(spark, items):
    df = spark.createDataFrame(items, "item_id long, text string")
    for name in ("row", "term", "item", "weight", "id", "block", "shard"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize(("postings", "terms", "k"), [(2_000_000, 400_000, 10), (300, 20, 10), (100, 1000, 3)])
def test_as_plain(spark, odd, postings, terms, k):
    texts, items = corpus()
    rows = list(enumerate(texts, 1000))
    got = best_position.search(odd(texts, [i for i, _ in rows]), item_table(spark, items), k, shard_postings=postings,
                               block_terms=terms).collect()
    assert Counter(map(tuple, got)) == brute(rows, items, k)


def test_stops_early_and_only_strictly_below():
    """Few positions of long lists are read, and ties beyond the k-th are all seen."""
    n = 20_000
    rng = np.random.default_rng(8)
    tfs = np.stack([rng.zipf(1.5, n).clip(1, 10**6) for _ in range(3)], axis=1).reshape(-1)
    lists = ImpactLists(pa.array(["a", "b", "c"] * n), np.full(n, 3), tfs, np.full(n, 100))
    impacts = (1_000_000_000 * tfs) // (1000 * tfs + 800)
    want = impacts.reshape(n, 3) @ np.array([5, 3, 2])
    docs, scores, read = lists.search([("a", 5), ("b", 3), ("c", 2), ("none", 9)], 10)
    assert read < 3 * n / 4 and (want[docs] == scores).all()
    assert set(np.flatnonzero(want >= np.sort(want)[-10])) <= set(docs)
    same = ImpactLists(pa.array(["a"] * 500), np.full(500, 1), np.full(500, 7), np.full(500, 100))
    assert len(same.search([("a", 1)], 10)[0]) == 500


def test_threshold_counts_directly_seen_positions():
    """The first document of each list is at the second place of the other. Reading one position sees two of each, so
    the best positions reach the second place and the third documents are never read."""
    tfs = {"a": [90, 80, 5, 4], "b": [80, 90, 4, 5]}
    terms = pa.array(["a", "b"] * 4)
    lists = ImpactLists(terms, np.full(4, 2), np.array([tfs[t][d] for d in range(4) for t in "ab"]), np.full(4, 1000))
    docs, scores, read = lists.search([("a", 1), ("b", 1)], 2, first=1)
    at = {tf: (1_000_000_000 * tf) // (1000 * tf + 8000) for tf in (80, 90)}
    assert docs.tolist() == [0, 1] and scores.tolist() == [at[80] + at[90]] * 2 and read == 2
    assert 2 * at[80] < at[80] + at[90] < 2 * at[90]  # last-read positions would not have stopped here


def test_rows_without_id_repeats_and_empty_tables(spark, odd):
    rows = [(None, "p q"), (4, "p q"), (4, "p q"), (2, "p q"), (9, "r s t u"), (8, "v")]
    items = [(1, "p"), (2, "r x"), (None, "q")]
    got = best_position.search(odd([t for _, t in rows], [i for i, _ in rows]), item_table(spark, items)).collect()
    assert Counter(map(tuple, got)) == brute(rows, items)
    for docs, wanted in (([], items), (["p"], []), ([None, ""], items), (["z"], items)):
        assert best_position.search(odd(docs), item_table(spark, wanted)).collect() == []
