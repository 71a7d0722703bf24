"""SimHash classes against all pairs in plain Python."""

import random
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tablefolio.llm import simhash
from tablefolio.llm.queries import QUERIES
from tablefolio.plans.catalogue import table


def plain_fingerprint(text):
    """Bit by bit from the rule."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] if word else words, ""
        else:
            word += c
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def united(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in nodes}


def brute(rows):
    """(id, fingerprint, component) of rows with distinct ids."""
    fps = {i: plain_fingerprint(t) for i, t in rows}
    comp = united(fps, [(a, b) for a, b in combinations(sorted(fps), 2) if (fps[a] ^ fps[b]).bit_count() <= 2])
    return {(i, f"{fp:016x}", comp[i]) for i, fp in fps.items()}


def corpus():
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "ß", "x y", "A", "a"]
    texts = [None, "", " \n\t", "one", "ONE", "one two", "One\x0btwo", "a b c", "A B C", "a b c d", "\x1c", "İ i"]
    for _ in range(30):
        words = rng.choices(vocabulary, k=rng.randint(40, 400))
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    rng.shuffle(texts)
    return texts


def test_as_all_pairs(odd):
    rows = list(enumerate(corpus(), 100))
    got = simhash.near_fingerprints(odd([t for _, t in rows], [i for i, _ in rows])).collect()
    want = brute(rows)
    assert len(got) == len(rows) and {tuple(r) for r in got} == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some links are between different fingerprints


def test_long_text_in_pieces():
    rng = random.Random(2)
    text = " ".join(rng.choices(["ab", "c", "d" * 50, "é"], k=3000)) + "  tail"
    whole = simhash.fingerprint(text.encode())
    assert whole % (1 << 64) == plain_fingerprint(text)
    assert all(simhash.fingerprint(text.encode(), p) == whole for p in (1, 7, 100, 5000))
    assert simhash.fingerprint(b"one two", 1) % (1 << 64) == plain_fingerprint("one two")


@pytest.mark.parametrize(("small", "share"), [(32, 500), (2, 500), (2, 1), (4, 3), (10**6, 1)])
def test_keys_of_any_size(spark, small, share):
    """Whatever way keys take, links are true links and form the components of all pairs."""
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = {0, (1 << 64) - 1, base}
    while len(fps) < 150:  # many share 32 or 48 bits, some by chance, some through chains
        near = rng.choice(sorted(fps)) if rng.random() < 0.6 else base
        for b in rng.sample(range(rng.choice([16, 32, 64])), rng.choice([1, 2, 2, 3, 4, 9])):
            near ^= 1 << b
        fps.add(near)
    signed = {simhash._signed(x) for x in fps}
    got = {(r.a, r.b) for r in simhash.close_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"), small, share).collect()}
    want = {(a, b) for a, b in combinations(sorted(signed), 2) if ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert got <= want and united(signed, got) == united(signed, want)
    assert small < 100 or got == want


def test_long_keys_give_few_rows(spark):
    """20,000 fingerprints with 32 common bits: no pair of them is made but those that are links."""
    rng = random.Random(4)
    fps = [(x,) for x in {rng.getrandbits(31) for _ in range(20_000)}]
    got = {(r.a, r.b) for r in simhash.close_pairs(spark.createDataFrame(fps, "fp long")).collect()}
    known = {x for x, in fps}
    flips = [1 << b for b in range(32)] + [1 << b | 1 << c for b, c in combinations(range(32), 2)]
    want = {(x, x ^ f) for x in known for f in flips if x ^ f in known and x < x ^ f}
    assert want and got <= want and united(known, got) == united(known, want)


def test_repeats_nulls_and_empty_table(odd):
    """Two texts of document 5 link what is near either of them; rows without id link but name nothing."""
    def near(texts, ids):
        return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id)
                      for r in simhash.near_fingerprints(odd(texts, ids)).collect())

    assert near(["a b c", "a b c", "x y z", "x y z"], [3, 5, 5, 9]) == [(3, 3), (5, 3), (5, 3), (9, 3)]
    assert near(["a b c", "a b c", "p q r", "", None], [None, 4, None, 7, 8]) == [(-1, -1), (-1, 4), (4, 4), (7, 7), (8, 7)]
    assert near(["s s s", "s s s"], [2, 2]) == [(2, 2), (2, 2)]
    assert simhash.near_fingerprints(odd([])).collect() == []


def test_query_as_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op13_simhash_duplicates"].run(spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_names_that_clash(odd):
    df = odd(["a b c", "a b c"])
    for name in ("fp", "t", "key", "size", "comp", "least", "component_id", "fingerprint", "__id"):
        df = df.withColumn(name, F.lit("x"))
    assert [r.component_id for r in simhash.near_fingerprints(df).collect()] == [0, 0]
