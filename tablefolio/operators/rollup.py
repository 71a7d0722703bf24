"""Aggregates on several levels at once, and distinct counts that are kept as state and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.functions.dates import calendar


def share_cube(df: DataFrame, groups: tuple[str, ...], sums: dict[str, Column]) -> DataFrame:
    """Every combination of `groups` (null: all values together) with `level` (a bit for each group that is rolled up),
    the rows and `sums` in it, and the percentage of rows among all of its level. Rows are expanded once and aggregated
    before the one shuffle; the shares come from the aggregated rows."""
    level = F.grouping_id().alias("level")
    cube = df.cube(*groups).agg(level, F.count("*").alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    total = F.sum("rows").over(Window.partitionBy("level"))
    return cube.withColumn("share", F.round(F.lit(100.0) * F.col("rows") / total, 6))


def day_states(activity: DataFrame, user: str, time: str) -> DataFrame:
    """day, bucket, users (a bitmap of the integer ids that fall in the bucket): the state of each day."""
    return activity.where(F.col(user).isNotNull() & F.col(time).isNotNull()).groupBy(
        F.to_date(time).alias("day"), F.bitmap_bucket_number(user).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))


def merged_days(*states: DataFrame) -> DataFrame:
    """One state from several: days that come again, late ones too, are united bit by bit, and none is counted twice."""
    out = states[0]
    for more in states[1:]:
        out = out.unionByName(more)
    return out.groupBy("day", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def weekly_users(state: DataFrame) -> DataFrame:
    """year, week, last_day, users: exact distinct users per ISO week, from the states of its days alone."""
    cal = calendar(F.col("day"))
    weeks = state.groupBy(F.extract(F.lit("YEAROFWEEK"), "day").cast("int").alias("year"), cal["week"].alias("week"), "bucket").agg(
        F.bitmap_or_agg("users").alias("users"), F.max("day").alias("day"))
    return weeks.groupBy("year", "week").agg(F.max("day").alias("last_day"), F.sum(F.bitmap_count("users")).alias("users"))


def active_days(activity: DataFrame, user: str, time: str) -> DataFrame:
    """user, year, week, days (bits of the week days, Monday first): mergeable by bit_or; their number is bit_count."""
    day = F.to_date(time)
    cal = calendar(day)
    bit = F.call_function("shiftleft", F.lit(1), F.weekday(day))
    return activity.where(F.col(user).isNotNull() & F.col(time).isNotNull()).groupBy(
        user, F.extract(F.lit("YEAROFWEEK"), day).cast("int").alias("year"), cal["week"].alias("week")).agg(
        F.bit_or(bit).alias("days"))
