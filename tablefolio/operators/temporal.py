"""Joins in time: the last value known at a moment, and moments inside intervals. No inequality join is planned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.session import durable

GROUP_ROWS = 1 << 19  # rows of one window group of interval totals, on average
LEAST_CAP = 10
COMBINED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def as_of(left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_time: str, right_time: str,
          values: tuple[str, ...], ranges: int | None = None,
          cut: Callable[[DataFrame], DataFrame] = durable) -> DataFrame:
    """`left` with `values` of the latest row of `right` that has the same keys and is not later; null without one.

    Both sides become one table, dealt to ranges of (keys, time): a key with very many rows covers several ranges. Inside
    a range the last value is carried by a window; what a range begins with comes from one record per key and range.
    Of right rows at the same time the one with the largest values counts. Rows of `right` with a null key or time never
    match, nor do left rows with one. Left rows keep all their columns, whatever their names.
    """
    spark = left.sparkSession
    by = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    names = [f"k{i}" for i in range(len(keys))]
    value = F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    moments = left.select(*by, F.col(left_time).alias("time"), F.lit(1).alias("side"),
                          F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(left.columns)]).alias("row"))
    known = right.dropna(subset=[*keys, right_time]).select(
        *by, F.col(right_time).alias("time"), F.lit(0).alias("side"), value.alias("value"))
    both = moments.unionByName(known, allowMissingColumns=True)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(both.repartitionByRange(n, *names, "time", "side").withColumn("part", F.spark_partition_id()))
    records = dealt.groupBy("part", *names).agg(F.max(F.when(F.col("side") == 0, F.struct("time", "value"))).alias("last"))
    before = Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = records.select("part", *names, F.last("last", ignorenulls=True).over(before)["value"].alias("before"))
    inside = Window.partitionBy("part", *names).orderBy("time", "side", "value").rowsBetween(Window.unboundedPreceding, 0)
    told = dealt.withColumn("inside", F.last("value", ignorenulls=True).over(inside))
    same = [told["part"] == carried["part"], *[told[k].eqNullSafe(carried[k]) for k in names]]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    found = told.where("side = 1").join(carried, on, "left").select(
        "row", F.when(told["time"].isNotNull(), F.coalesce("inside", "before")).alias("value"))
    return found.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(left.columns)],
                        *[F.col(f"value.v{i}").alias(v) for i, v in enumerate(values)])


def _bucket(place: Column, level: Column) -> Column:
    return F.call_function("shiftright", place, level)


def _width(low: Column, high: Column) -> Column:
    return F.length(F.bin(high - low)).cast("int")


def in_intervals(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, keys: tuple[str, ...] = (),
                 totals: dict[str, tuple[str, Column]] | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """All pairs of a point and an interval (ends included) that holds it, with the columns of both, which must have
    different names but for `keys`. Places are longs; nulls and intervals that end before they begin hold nothing.

    An interval belongs to the level whose buckets, of a power of two, are wider than it, so it lies in two buckets at
    most. A point lies in one bucket of each level that occurs (64 at most), so a pair meets in exactly one bucket.

    With `totals` (name -> (count, sum, min or max; column of the points)) the result has each interval that holds a
    point, with the totals of its points, and no pair is ever made: their number grows with the square of the density.
    """
    whole = intervals.where(F.col(low) <= F.col(high))
    if totals is not None:
        return _with_totals(points, whole, point, low, high, keys, totals, group_rows)
    whole = whole.withColumn("__level", _width(F.col(low), F.col(high)))
    first, last = _bucket(F.col(low), F.col("__level")), _bucket(F.col(high), F.col("__level"))
    placed = whole.withColumn("__bucket", F.explode(F.sequence(first, last)))
    levels = sorted(r[0] for r in whole.select("__level").distinct().collect())
    asked = points.where(F.col(point).isNotNull()).select("*", _homes(F.col(point), levels or [1]))
    met = asked.join(placed, [*keys, "__level", "__bucket"])
    return met.where((F.col(low) <= F.col(point)) & (F.col(point) <= F.col(high))).drop("__level", "__bucket")


def _homes(place: Column, levels: list[int]) -> Column:
    """The bucket of a place on each level."""
    return F.inline(F.array(*[F.struct(F.lit(n).alias("__level"), F.shiftright(place, n).alias("__bucket")) for n in levels]))


def _with_totals(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, keys: tuple[str, ...],
                 totals: dict[str, tuple[str, Column]], group_rows: int) -> DataFrame:
    """One record per place that has points, one question per different interval; the answers meet the intervals."""
    kinds = {n: how for n, (how, _) in totals.items()}
    own = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    known = points.dropna(subset=[*keys, point]).groupBy(*keys, F.col(point).alias("__place")).agg(
        F.count("*").alias("__n"), *[own[how](c).alias(n) for n, (how, c) in totals.items()])
    asked = intervals.dropna(subset=list(keys)) if keys else intervals
    asked = asked.select(*keys, F.col(low).alias("__low"), F.col(high).alias("__high")).distinct()
    answers = _answers(known, asked, keys, {"__n": "count"} | kinds, group_rows).where("__n > 0")
    met = intervals.withColumns({"__low": F.col(low), "__high": F.col(high)}).join(answers, [*keys, "__low", "__high"])
    return met.select(*intervals.columns, *totals)


def _answers(known: DataFrame, asked: DataFrame, keys: tuple[str, ...], kinds: dict[str, str],
             group_rows: int) -> DataFrame:
    """Totals of the places from `__low` to `__high`, per question.

    On the level whose buckets are at most as wide as the interval it begins in one bucket and ends in another, with one
    between them at most. So it needs the end of a bucket, the start of one and perhaps a whole one: running totals down
    and up. No level has buckets of more than `group_rows` rows on average; longer intervals take the buckets between
    their ends as places, in a turn of their own.
    """
    n, least, most = known.agg(F.count("*"), F.min("__place"), F.max("__place")).first()
    wide = (_width(F.col("__low"), F.col("__high")) - 1).alias("__wide")
    sizes = asked.groupBy(wide).count().collect()
    rows = n + sum(r[1] for r in sizes)
    cap = 63 if rows <= group_rows else max(LEAST_CAP, ((most - least + 1 if n else 1) * group_rows // rows).bit_length() - 1)
    levels = sorted({min(r[0], cap) for r in sizes}) or [0]
    level = F.col("__level")
    placed = asked.select("*", wide).withColumn("__level", F.least("__wide", F.lit(cap))).withColumns({
        "__first": _bucket(F.col("__low"), level), "__last": _bucket(F.col("__high"), level)})

    def question(bucket: Column, place: Column, up: bool) -> Column:
        return F.struct(bucket.alias("__bucket"), place.alias("__place"), F.lit(up).alias("__up"))

    between = F.call_function("shiftleft", F.col("__first") + 2, level) - 1
    questions = F.array_compact(F.array(
        question(F.col("__first"), F.col("__low"), False),
        F.when(F.col("__last") > F.col("__first"), question(F.col("__last"), F.col("__high"), True)),
        F.when((F.col("__wide") <= cap) & (F.col("__last") - F.col("__first") == 2),
               question(F.col("__first") + 1, between, True))))
    both = known.select("*", _homes(F.col("__place"), levels)).unionByName(
        placed.select(*keys, "__low", "__high", "__level", F.inline(questions)), allowMissingColumns=True)
    bucket = Window.partitionBy(*keys, "__level", "__bucket")  # frames by range: places of the same value count in
    up, down = bucket.orderBy("__place"), bucket.orderBy(F.col("__place").desc())
    told = both.withColumns({f"__up_{t}": COMBINED[how](t).over(up) for t, how in kinds.items()}).withColumns(
        {f"__down_{t}": COMBINED[how](t).over(down) for t, how in kinds.items()})
    found = told.where("__up IS NOT NULL").select(
        *keys, "__low", "__high", *[F.when(F.col("__up"), F.col(f"__up_{t}")).otherwise(F.col(f"__down_{t}")).alias(t) for t in kinds])
    if any(r[0] > cap for r in sizes):
        long = placed.where((F.col("__wide") > cap) & (F.col("__last") - F.col("__first") > 1)).select(
            *keys, F.col("__low").alias("__from"), F.col("__high").alias("__to"),
            (F.col("__first") + 1).alias("__low"), (F.col("__last") - 1).alias("__high"))
        records = known.groupBy(*keys, _bucket(F.col("__place"), F.lit(cap)).alias("__place")).agg(
            *[COMBINED[how](t).alias(t) for t, how in kinds.items()])
        ends = [*keys, "__low", "__high"]
        inner = long.join(_answers(records, long.select(*ends).distinct(), keys, kinds, group_rows), ends)
        found = found.unionByName(inner.select(
            *keys, F.col("__from").alias("__low"), F.col("__to").alias("__high"), *kinds))
    return found.groupBy(*keys, "__low", "__high").agg(*[COMBINED[how](t).alias(t) for t, how in kinds.items()])
