"""Name functions and company matching against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tablefolio.functions import names as N
from tablefolio.functions.fuzzy import best_window_ratio, indel_ratio
from tablefolio.operators import entity
from tablefolio.operators.similar import letter_index, letter_pairs, prefix_size, similar_texts
from tablefolio.plans.matching_run import run_matching


def common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def slow_ratio(a, b):
    return round(200 * common(a, b) / (len(a) + len(b))) if a or b else 100


def slow_window_ratio(a, b):
    short, long = sorted((a, b), key=len)
    m, n = len(short), len(long)
    if m == 0:
        return 100 if n == 0 else 0
    return max(slow_ratio(short, long[max(0, s): s + m]) for s in range(1 - m, n))


def test_ratio_against_table(spark):
    """One word of bits, its limits, several words, and characters outside the basic plane."""
    rng = random.Random(3)
    rows = [["".join(rng.choice("abc dé😀") for _ in range(rng.choice([0, 1, 5, 12, 59, 60, 61, 120, 121, 190]))) for _ in "ab"]
            for _ in range(250)]
    rows += [["stone bridge", "stonebridge"], ["", ""], ["", "x"]]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", indel_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(r.r == slow_ratio(r.a, r.b) for r in got) and [r.r for r in got[-3:]] == [96, 100, 0]


def test_window_ratio_against_table(spark):
    rng = random.Random(4)
    rows = [["".join(rng.choice("abc d") for _ in range(rng.randint(0, 9))) for _ in "ab"] for _ in range(150)]
    rows += [["bridge", "stonebridge"]]
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", best_window_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(r.r == slow_window_ratio(r.a, r.b) for r in got) and got[-1].r == 100


@pytest.mark.parametrize(("limit", "part_size"), [(70, 3), (86, 4096), (96, 3)])
def test_similar_texts_are_all_found(spark, limit, part_size):
    rng = random.Random(limit)
    texts = {(rng.choice("gh"), "".join(rng.choice("aab c") for _ in range(rng.randint(0, 14)))) for _ in range(250)}
    base = "harbor point 1234 capital"
    texts |= {("g", base[:k] + rng.choice("xyz 5") * rng.randint(0, 3) + base[k + rng.randint(0, 2):]) for k in range(len(base))}
    texts = sorted(texts)
    asked, indexed = texts[::2], texts[1::2] + texts[:20]
    tables = [spark.createDataFrame(x, "g string, text string") for x in (asked, indexed)]
    got = [tuple(r) for r in similar_texts(*letter_index(*tables, "g", lambda df: df, part_size), "g", limit).collect()]
    want = {(g, a, b, slow_ratio(a, b)) for g, a in asked for h, b in indexed if g == h and slow_ratio(a, b) >= limit}
    assert len(got) == len(set(got)) and set(got) == want


def test_index_meets_few_pairs(spark):
    """Of 300 x 300 names of one identifier only those with a rare pair in common are scored."""
    rows = [("g", f"harbor point {k * 7919 % 100000:05d} capital") for k in range(300)]
    df = spark.createDataFrame(rows, "g string, text string")
    sizes = df.select(F.sum(prefix_size(F.length("text"), 96)).alias("shown"), F.sum(F.size(letter_pairs(F.col("text")))).alias("held"))
    assert sizes.first().shown < sizes.first().held / 3
    got = {(r.text, r.other) for r in similar_texts(*letter_index(df, df, "g", lambda x: x), "g", 96).collect()}
    assert got == {(a, b) for _, a in rows for _, b in rows if slow_ratio(a, b) >= 96}


@pytest.mark.parametrize("raw, clean", [
    ('Orlan Group (XNYS:ORLN) (fka "Orlan Machines Co, Ltd")', "Orlan Group"), ("RED PINE 8", "Red Pine"),
    ("Dusk Harbor Software Ltd. (dba Duskora)", "Duskora"), ("* Acme, Inc.", "Acme"), ("Vintera Holding, B.V.  ", "Vintera Holding"),
    ("Quellmark  International GmbH ", "Quellmark International"), ('"Quoted" Co. Ltd', "Quoted")])
def test_clean(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(N.clean_company_name(F.col("n"))).first()[0] == clean


@pytest.mark.parametrize("name, identifier", [
    ("Neural", "neural"), ("Neural Science", "neural"), ("Neural Science Works", "neural science"), ("AB Corp X", "ab corp"),
    ("AB X", "ab x")])
def test_identifier(spark, name, identifier):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(N.block_identifier(F.col("n"))).first()[0] == identifier


def block_of(n):
    w = n.split()
    return " ".join(w[:-1]).lower() if len(w) > 1 and len("".join(w[:-1])) >= 4 else n.lower()


def brute_force(names, master):
    """company -> id by scoring every pair of a block, straight from the matching rule."""
    block, out = block_of, {}
    for n in set(names):
        scored = sorted(((slow_ratio(n.lower(), m.lower()), m) for _, m in master if block(m) == block(n)),
                        key=lambda p: -p[0])
        if len(scored) == 1 or (len(scored) > 1 and scored[0][0] > 85 and scored[0][0] > scored[1][0]):
            out[n] = min(i for i, m in master if m == scored[0][1])
    return out


@pytest.mark.parametrize(("list_size", "few"), [(2, 0), (256, 16)])
def test_matching_against_brute_force(spark, monkeypatch, list_size, few):
    monkeypatch.setattr(entity, "FEW", few)
    rng = random.Random(11)
    lasts = ["alpha", "alphas", "beta", "betas", "gamma", "gammax", "delta", "deltaxx", "omega", "omegas", "zeta"]
    fronts = ["Harbor Point", "Harbor", "Northern Light House", "Ab"]

    def name():
        return f"{rng.choice(fronts)} {rng.choice(lasts)}"

    master = [(i, name() if i % 2 else f"Harbor Point {rng.choice(lasts)}{rng.randint(0, 30)}") for i in range(120)]
    names = [name() for _ in range(60)] + [f"Harbor Point {rng.choice(lasts)}{rng.randint(0, 40)}" for _ in range(60)]
    extracted = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "row int, company_name string")
    df = spark.createDataFrame(master, "company_id int, company_name_master string")
    done = entity.match_companies(extracted, df, "ratio", list_size=list_size)
    got = {r.company_name: r.company_id for r in done.collect()}
    want = brute_force(list(got), master)
    assert done.count() == len(names) and {n: i for n, i in got.items() if i is not None} == want
    best = entity.best_candidates(extracted, entity.clean_master(df), "ratio", list_size=list_size).collect()
    for r in best:
        assert r.score == slow_ratio(r.company_name.lower(), r.candidate.lower()) and r.place <= 5
    scores = {}
    for n, m in {(n, m) for n in names for _, m in master}:
        if block_of(n) == block_of(m):
            scores.setdefault(n, []).append((-slow_ratio(n.lower(), m.lower()), m))
    assert {(r.company_name, r.place, r.score, r.candidate) for r in best} == {
        (n, k, -s, m) for n, found in scores.items() for k, (s, m) in enumerate(sorted(found)[:5], 1)}


def test_decision_rule(spark):
    def best(name, scores):
        return [(name, len(scores), f"m{i}", 1, i, s, i + 1) for i, s in enumerate(scores)]

    rows = best("one", [10]) + best("tie", [90, 90]) + best("clear", [90, 80]) + best("limit", [85, 10])
    df = spark.createDataFrame(rows, "company_name string, n_candidates int, candidate string, copies int, "
                                     "company_id int, score int, place int")
    assert {r.company_name: r.company_id for r in entity.decide(df).collect()} == {
        "one": 0, "tie": None, "clear": 0, "limit": None}


def test_matching_run_replaces_its_table(spark):
    spark.sql("DROP TABLE IF EXISTS portfolio_company_validated")
    spark.createDataFrame([(1, "Acme Works Inc."), (2, "Lone Star")], "row int, company_name string").write.saveAsTable(
        "portfolio_company_validated")
    spark.createDataFrame([(7, "ACME WORKS"), (8, "Other One")], "CompanyID int, CompanyName string"
                          ).createOrReplaceTempView("master_list")
    for _ in range(2):  # the second run reads the first run's result
        run_matching(spark, "full", {"full": "portfolio_company_validated"}, "master_list")
        got = {r.company_name: r.company_id for r in spark.table("portfolio_company_validated").collect()}
        assert got == {"Acme Works": 7, "Lone Star": None}
    spark.sql("DROP TABLE portfolio_company_validated")


def test_modes():
    tables = {"full": "a_table", "partial": "another"}
    assert entity.table_for_mode("full", tables) == "a_table"
    with pytest.raises(ValueError):
        entity.table_for_mode("other", tables)


def test_window_ratio_keeps_the_rule(spark):
    """A name that lies inside another master name ties with it at 100: the equal one must not win unseen."""
    master = spark.createDataFrame([(1, "Harbor Point One"), (2, "Harbor Point Onex"), (3, "Northern Light House Two")],
                                   "company_id int, company_name_master string")
    names = spark.createDataFrame([(0, "Harbor Point One"), (1, "Northern Light House Two")], "row int, company_name string")
    for scorer, want in (("window_ratio", None), ("ratio", 1)):
        got = {r.row: r.company_id for r in entity.match_companies(names, master, scorer).collect()}
        assert got == {0: want, 1: 3}
