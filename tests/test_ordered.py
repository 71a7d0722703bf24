"""Segmented computations equal plain windows, also when one group holds most rows."""

import random

import pytest
from pyspark.sql import functions as F

from tablefolio.operators.ordered import RowOrder


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for key, size in (("hot", 97), ("a", 1), ("b", 7), ("c", 14), ("d", 15)):
        data += [(key, i, rng.randint(0, 9), rng.choice([None, "x", "y", "z"])) for i in range(size)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, i int, n int, v string").repartition(5)


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))


@pytest.mark.parametrize("segment", [3, 7, 50])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running(rows, segment, inclusive):
    value = F.when(F.col("v").isNotNull(), F.struct("i", "v"))

    def run(order):
        return order.running(rows, {"s": F.col("n")}, {"m": F.col("n"), "last": value}, inclusive)

    same(run(RowOrder(("k",), "i", None)), run(RowOrder(("k",), "i", segment)))


@pytest.mark.parametrize("segment", [5, 7, 50])
def test_neighbours(rows, segment):
    wanted = {"a": (F.col("n"), -2), "b": (F.col("v"), -1), "c": (F.col("n"), 1), "d": (F.lit(True), 3)}
    same(RowOrder(("k",), "i", None).neighbours(rows, wanted), RowOrder(("k",), "i", segment).neighbours(rows, wanted))


def test_dense_and_last(rows):
    order = RowOrder(("k",), "i", 7)
    gaps = rows.where("n > 3")
    numbered = order.dense(gaps, "p").collect()
    for key in {r.k for r in numbered}:
        mine = sorted((r for r in numbered if r.k == key), key=lambda r: r.i)
        assert [r.p for r in mine] == list(range(len(mine)))
    ends = {(r.k, r.from_end): r.i for r in order.last_rows(rows, 2).collect()}
    assert ends[("hot", 1)] == 96 and ends[("hot", 2)] == 95 and ("a", 2) not in ends


def test_running_after_neighbours(rows):
    def run(order):
        near = order.neighbours(rows, {"before": (F.col("n"), -1)}, keep_segment=True)
        return order.running(near, {"s": F.col("before")})

    same(run(RowOrder(("k",), "i", None)), run(RowOrder(("k",), "i", 7)))
