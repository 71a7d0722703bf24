"""Near-duplicate classes against all pairs in plain Python."""

import random
from itertools import combinations

import numpy as np

from tablefolio.llm import minhash


def brute(rows, percent=85):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choices(vocabulary, k=rng.randint(30, 120)) for _ in range(25)]
    texts = [None, "", "  \n", "one two", "ONE two", "one two three four five", " one two", "İ x", "i̇ x"]
    for words in base:
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 8)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(("\n" if rng.random() < 0.5 else " ").join(copy))
    hub = rng.choices(vocabulary, k=150)  # one large group, not all of it linked to each other
    for _ in range(60):
        copy = list(hub)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts.append(" ".join(rng.choices(vocabulary, k=60_000)))
    rng.shuffle(texts)
    return texts


def test_as_all_pairs(odd):
    rows = list(enumerate(corpus()))
    df = odd([t for _, t in rows])
    for percent in (85, 80):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, percent=percent).collect()}
        assert got == brute(rows, percent)


def test_blocks_of_a_bucket(spark):
    """Every pair of different components meets in one pair of blocks, but for those with the hub."""
    rng = np.random.default_rng(2)
    one = rng.integers(-2**62, 2**62, minhash.BANDS)
    rows = [(0, 7, 4, 23, 230, i, i % 3, [int(x) for x in one]) for i in range(23)]
    members = spark.createDataFrame(rows, "band int, key long, hub long, m long, shingles long, id long, comp long, sig array<long>")
    want = {(a, b) for a, b in combinations([i for i in range(23) if i != 4], 2) if a % 3 != b % 3}
    for block, set_block in ((5, 1000), (100, 50), (100, 1000)):
        met = minhash.meeting(members, 0.8, block, set_block).collect()
        pairs = [(a.id, b.id) for a, b in combinations(sorted(met, key=lambda r: r.id), 2)
                 if (a.lo, a.hi) == (b.lo, b.hi) and a.comp != b.comp and (a.lo == a.hi or a.own != b.own)]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want
        assert len(met) <= 22 * max(23 / block, 230 / set_block, 1) + 22


def test_pages_of_a_template_below_the_limit(spark, odd, monkeypatch):
    """Nearly all pairs are close to the limit, and few are links: what leaves the blocks is less than the pages."""
    rng = random.Random(8)
    core = [f"c{k}" for k in range(400)]

    def page():
        words = list(core)
        for k in rng.sample(range(0, 400, 5), 9):
            words[k] = f"x{rng.randrange(10**9)}"
        return words

    pages = [page() for _ in range(400)]
    for k in range(0, 40, 2):  # some are links
        pages[k + 1] = [*pages[k][:-1], "other"]
    rows = list(enumerate(" ".join(p) for p in pages))
    written, sizes = minhash.written, {}

    def counted(df, name):
        out = written(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(minhash, "written", counted)
    monkeypatch.setattr(minhash, "BLOCK", 64)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(odd([t for _, t in rows])).collect()}
    want = brute(rows)
    assert got == want and len({c for _, c, _ in want.values()}) > 300
    assert sizes["minhash-rest"] < len(rows)


def test_two_texts_under_one_id(odd):
    """An id stands for all its texts: each of them links, and so do they."""
    rng = random.Random(9)
    common, other = (" ".join(rng.choices([f"w{k}" for k in range(500)], k=100)) for _ in range(2))
    near = other.rsplit(" ", 1)[0] + " end"
    df = odd([common, common, other, near, "alone in all its words here"], [1, 2, 2, 3, 4])
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_estimate_follows_similarity():
    order, rng = minhash.probes(), np.random.default_rng(1)
    for share in (0.3, 0.8, 0.9):
        found = []
        for _ in range(40):
            common = int(300 * share)
            a = rng.integers(0, 2**63, 300, dtype=np.uint64)
            b = np.concatenate([a[:common], rng.integers(0, 2**63, 300 - common, dtype=np.uint64)])
            signatures = [minhash.signature(np.unique(x), order).view(np.uint64) for x in (a, b)]
            found.append(minhash.estimate(*signatures) - common / (600 - common))
        assert abs(np.mean(found)) < 0.02 and np.std(found) < 0.04


def test_repeats_nulls_and_empty_table(odd):
    df = odd(["a b c d e f", "a b c d e f", "x", None, "a b c d e f"], [4, 4, 9, 9, None])
    got = sorted(((r.doc_id or -1), r.n_shingles, r.component_id or -1, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, 2, -1, True), (4, 2, 4, True), (4, 2, 4, True), (9, 0, 9, True), (9, 1, 9, True)]
    assert minhash.near_duplicates(odd([])).collect() == []
    assert [r.component_id for r in minhash.near_duplicates(odd([None, "", " "])).orderBy("doc_id").collect()] == [0, 1, 2]
