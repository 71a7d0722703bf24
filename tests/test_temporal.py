"""Joins in time against plain loops, merged states, cubes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablefolio.operators import rollup, temporal
from tablefolio.operators.temporal import as_of, in_intervals


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_as_of_against_loop(spark, ranges):
    """One key holds most rows, so it covers several ranges; nulls, ties and names that clash with those used inside."""
    rng = random.Random(1)
    left = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([*range(200), None]), i) for i in range(400)]
    right = [(rng.choice(["hot"] * 8 + ["a", "c", None]), rng.choice([*range(0, 200, 3), None]), rng.randint(0, 9)) for _ in range(150)]
    out = as_of(spark.createDataFrame(left, "key string, time long, part int"),
                spark.createDataFrame(right, "key string, since long, value int"), ("key",), "time", "since", ("since", "value"), ranges)
    assert out.columns == ["key", "time", "part", "since", "value"]

    def last(key, time):
        found = [(s, v) for k, s, v in right if k is not None and k == key and s is not None and time is not None and s <= time]
        return max(found, default=(None, None))

    assert Counter(map(tuple, out.collect())) == Counter((k, t, i, *last(k, t)) for k, t, i in left)


def test_as_of_several_keys_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (2, "x", 1)], "a int, b string, t int")
    right = spark.createDataFrame([(1, "x", 4, 0.5), (1, "x", 6, 0.6), (2, "x", 1, 0.7)], "a int, b string, s int, v double")
    got = {(r.a, r.b): r.v for r in as_of(left, right, ("a", "b"), "t", "s", ("v",)).collect()}
    assert got == {(1, "x"): 0.5, (1, "y"): None, (2, "x"): 0.7}
    assert [r.v for r in as_of(left, right.limit(0), ("a", "b"), "t", "s", ("v",)).collect()] == [None] * 3
    assert as_of(left.limit(0), right, ("a", "b"), "t", "s", ("v",)).collect() == []


def test_in_intervals_against_loop(spark):
    rng = random.Random(2)
    points = [(i, rng.choice([None, *range(-60, 300)])) for i in range(150)]
    intervals = [(i, lo, lo + rng.choice([-3, 0, 1, 2, 7, 8, 9, 64, 1000])) for i, lo in enumerate(rng.choices(range(-80, 300), k=80))]
    intervals += [(900, None, 5), (901, 5, None), (902, -10**9, 10**9), (903, 7, 7)]
    frames = (spark.createDataFrame(points, "p int, place long"), spark.createDataFrame(intervals, "i int, low long, high long"))
    met = in_intervals(*frames, "place", "low", "high")
    want = {(p, i) for p, x in points for i, lo, hi in intervals if None not in (x, lo, hi) and lo <= x <= hi}
    got = [(r.p, r.i) for r in met.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    keyed = [f.withColumn("k", F.col(c) % 3) for f, c in zip(frames, "pi", strict=True)]
    assert {(r.p, r.i) for r in in_intervals(*keyed, "place", "low", "high", ("k",)).collect()} == {
        (p, i) for p, i in want if p % 3 == i % 3}
    assert in_intervals(frames[0], frames[1].where("low > high"), "place", "low", "high").collect() == []


@pytest.mark.parametrize("group_rows", [1 << 19, 8])
def test_interval_totals_against_loop(spark, group_rows, monkeypatch):
    """Totals without pairs, also where the longest intervals take whole buckets as places; repeats, nulls and ties."""
    monkeypatch.setattr(temporal, "LEAST_CAP", 2)
    rng = random.Random(4)
    points = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 7, *range(-60, 3000)]), i, rng.choice([None, 1, 5])) for i in range(300)]
    intervals = [(rng.choice(["a", "b", None]), lo, lo + rng.choice([-3, 0, 1, 2, 3, 7, 8, 9, 64, 1000, 2500])) for lo in rng.choices(range(-80, 3000), k=150)]
    intervals += [("a", 7, 7), ("a", 7, 7), ("b", -10**9, 10**9), ("a", -10**6, 2000), ("a", None, 5), ("a", 5, None)]
    frames = (spark.createDataFrame(points, "k string, place long, p int, v long"),
              spark.createDataFrame([(i, *x) for i, x in enumerate(intervals)], "i int, k string, low long, high long"))
    asked = {"n": ("count", F.lit(1)), "least": ("min", F.col("p")), "most": ("max", F.col("p")), "v": ("sum", F.col("v")),
             "vs": ("count", F.col("v"))}
    for keys in ((), ("k",)):
        sides = (frames[0] if keys else frames[0].drop("k"), frames[1])
        met = temporal.in_intervals(*sides, "place", "low", "high", keys, asked, group_rows)
        want = []
        for i, (k, lo, hi) in enumerate(intervals):
            held = [(p, v) for q, x, p, v in points if None not in (x, lo, hi) and lo <= x <= hi and (not keys or (q == k and k))]
            if held:
                values = [v for _, v in held if v is not None]
                want.append((i, k, lo, hi, len(held), min(p for p, _ in held), max(p for p, _ in held), sum(values) if values else None, len(values)))
        assert met.columns == ["i", "k", "low", "high", *asked]
        assert sorted(map(tuple, met.collect())) == sorted(want)
    empty = temporal.in_intervals(frames[0].limit(0).drop("k"), frames[1], "place", "low", "high", totals=asked)
    assert empty.collect() == []


def test_late_days_are_counted_once(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 7, 32_768, 10**12, 5, 6]), f"2024-0{rng.randint(1, 2)}-{rng.randint(1, 28):02d} 10:00:00") for _ in range(300)]
    df = spark.createDataFrame(rows, "user long, t string").select("user", F.col("t").cast("timestamp").alias("t"))
    early, late, again = (rollup.day_states(df.where(c), "user", "t") for c in ("day(t) % 5 > 0", "day(t) % 5 = 0", "day(t) % 2 = 0"))
    want = {(r.w): r.n for r in df.groupBy(F.weekofyear("t").alias("w")).agg(F.countDistinct("user").alias("n")).collect()}
    for state in (rollup.merged_days(early, late), rollup.merged_days(early, late, again, early)):
        assert {r.week: r.users for r in rollup.weekly_users(state).collect()} == want
    days = {(r.user, r.week): bin(r.days).count("1") for r in rollup.active_days(df, "user", "t").collect()}
    assert days == {(r.user, r.w): r.n for r in df.dropna().groupBy("user", F.weekofyear("t").alias("w")).agg(
        F.countDistinct(F.to_date("t")).alias("n")).collect()}


def test_cube_levels_and_shares(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4), (None, "x", 8)], "g string, h string, n int")
    cube = rollup.share_cube(df, ("g", "h"), {"total": F.col("n")}).collect()
    assert {(r.g, r.h, r.level): (r.rows, r.total, r.share) for r in cube if r.level in (1, 3)} == {
        ("a", None, 1): (2, 3, 50.0), ("b", None, 1): (1, 4, 25.0), (None, None, 1): (1, 8, 25.0), (None, None, 3): (4, 15, 100.0)}
    assert len(cube) == 4 + 3 + 2 + 1
