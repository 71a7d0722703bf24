"""Benchmark leaks: planted items with substitutions, and the rule in plain Python."""

import itertools
import random
import re

import pytest

from tablefolio.llm import decontam

ITEMS = "item_id long, text string, n string"


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "x") for i, t in rows], ITEMS)


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(docs, benchmark):
    """Every diagonal, every window that holds a seed; short items by the plain rule."""
    distinct = {}
    for i, t in benchmark:
        if words(t):
            distinct[tuple(words(t))] = min(i, distinct.get(tuple(words(t)), i))
    found = {}
    for d, text in docs:
        have = words(text)
        for item, i in distinct.items():
            size, span, masks = min(len(item), decontam.WINDOW), decontam.SPAN, decontam.MASKS
            if len(item) < decontam.WHOLE_UNDER:
                for at in range(len(have) - len(item) + 1):
                    n = sum(a == b for a, b in zip(item, have[at:], strict=False))
                    if n * 100 >= size * decontam.PERCENT:
                        found[d, i] = max(found.get((d, i), (n, -at, size)), (n, -at, size))
                continue
            for diagonal in range(-len(item), len(have)):
                equal = [0 <= diagonal + q < len(have) and have[diagonal + q] == item[q] for q in range(len(item))]
                if sum(equal) < len(masks[0]):
                    continue
                starts = [q for q in range(len(item) - span + 1) if 0 <= diagonal + q and diagonal + q + span <= len(have)
                          and any(all(equal[q + o] for o in m) for m in masks)]
                for s in range(max(0, -diagonal), min(len(item), len(have) - diagonal) - size + 1):
                    if any(s <= q and q + span <= s + size for q in starts) and sum(equal[s:s + size]) * 100 >= size * decontam.PERCENT:
                        best = (sum(equal[s:s + size]), -(diagonal + s), size)
                        found[d, i] = max(found.get((d, i), best), best)
    return {(d, i, -at, size, n) for (d, i), (n, at, size) in found.items()}


def cases():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    benchmark = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([4, 5, 7, 9, 10, 12, 19, 20, 21, 35, 60])]
    benchmark += [(90, benchmark[9][1].upper() + "."), (91, None), (92, ""), (-5, benchmark[7][1])]
    docs = [None, "", "w1"]
    for _, text in benchmark[:11]:
        for changed in (0, 1, 0.1, 0.25):
            item = text.split()
            for _ in range(int(changed if changed >= 1 else changed * len(item))):
                item[rng.randrange(len(item))] = "other"
            cut = item[rng.randint(0, 3):]
            for part in (item, cut):
                docs.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) + "! " + ", ".join(part) + "\n"
                            + " ".join(rng.choices(vocabulary, k=rng.randint(0, 30))))
    return list(enumerate(docs)), benchmark


@pytest.mark.parametrize("broadcast", [True, False])
def test_as_brute_force(odd, items, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 500_000 if broadcast else 0)
    docs, benchmark = cases()
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal)
           for r in decontam.leaks(odd([t for _, t in docs]), items(benchmark)).collect()}
    assert got == brute(docs, benchmark) and len(got) > 40


def test_four_substitutions_in_twenty(odd, items):
    rng = random.Random(5)
    item = [f"k{j}" for j in range(20)]
    docs = []
    for _ in range(200):
        copy = list(item)
        for j in rng.sample(range(20), 4):
            copy[j] = "z"
        docs.append("before it " + " ".join(copy) + " after it")
    assert len(decontam.leaks(odd(docs), items([(1, " ".join(item))])).collect()) >= 199


def test_clean_rows_stay_as_they_are(odd, items):
    item = " ".join(f"k{j}" for j in range(25))
    df = odd([item, "clean text", None, "", item, "x " + item, "same"], [1, 2, 3, 4, 1, None, None])
    out = decontam.without_leaks(df, items([(1, item)]))
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect() if r.text) == [(2, "clean text")]
    assert decontam.without_leaks(odd([]), items([(1, item)])).count() == 0
    assert decontam.without_leaks(df, items([])).count() == 7


def by_the_rule(docs, benchmark):
    """80 % of the words equal at some place, for items of up to 20 words; no seeds, no bounds."""
    found = set()
    for d, text in enumerate(docs):
        have = text.split()
        for i, item in benchmark:
            item = item.split()
            best = max(((sum(a == b for a, b in zip(item, have[p:], strict=False)), -p) for p in range(len(have) - len(item) + 1)),
                       default=(-1, 0))
            if best[0] * 10 >= len(item) * 8:
                found.add((d, i, -best[1], len(item), best[0]))
    return found


@pytest.mark.parametrize("broadcast", [True, False])
def test_short_items_by_the_plain_rule(odd, items, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", 500_000 if broadcast else 0)
    rng = random.Random(21)
    benchmark = [(n, " ".join(f"t{n}w{k % 7}" for k in range(n))) for n in range(1, 13)]
    docs = ["", "t1w0", "x t3w0 t3w1 y t3w2", "y t3w0 t3w1 t3w2"]
    for n, text in benchmark:
        for changed in range(4):
            for places in itertools.islice(itertools.combinations(range(n), changed), 60):
                copy = text.split()
                for k in places:
                    copy[k] = "other"
                docs.append(" ".join(rng.choices(["a", "b", "t9w1", "t4w0"], k=rng.randint(0, 4)) + copy
                                     + rng.choices(["a", "b", "t11w2"], k=rng.randint(0, 4))))
    got = {tuple(r) for r in decontam.leaks(odd(docs), items(benchmark)).select(
        "doc_id", "item_id", "first_word", "n_words", "n_equal").collect()}
    assert got == by_the_rule(docs, benchmark) and len(got) > 100
    left = {r.doc_id for r in decontam.without_leaks(odd(docs), items(benchmark)).collect()}
    assert left == set(range(len(docs))) - {x[0] for x in got}


def test_sql_finds_items_of_any_length(odd, items):
    """The SQL of the query against the same rule, on rows with short items."""
    duckdb = pytest.importorskip("duckdb")
    docs, benchmark = cases()
    benchmark = [*benchmark, (70, "w1"), (71, "w2 w3"), (72, "w4 w5 w6")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", benchmark)
    want = brute(docs, benchmark)
    assert set(con.execute(decontam.LEAKS_SQL).fetchall()) == want
    got = {(r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal)
           for r in decontam.leaks(odd([t for _, t in docs]), items(benchmark)).collect()}
    assert got == want and {70, 71} <= {i for _, i, *_ in want}


def test_share_of_an_item(odd, items):
    df = odd(["the cat", "the dog", "a bird", None, "the cat"], [1, 2, 3, 4, 1])
    got = {tuple(r) for r in decontam.item_shares(df, items([(5, "the"), (6, "the cat"), (7, "fish")])).collect()}
    assert got == {(5, 1, 2, 0.5), (6, 2, 1, 0.25)}
