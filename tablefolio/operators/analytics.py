"""Usage and company analytics: aggregates that combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.functions.dates import calendar, week_label

# Action that counts as a query, weeks looked back, and top-list limits.
QUERY_ACTION = "QUERY_RUN"
RECENT_WEEKS = 10
TOP_USERS = 5
ACTIVE_ABOVE = 3
INACTIVE_BELOW = 3
SLICES = 1024


def with_user_name(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Add `userName`, the date and the ISO week; unknown users keep a null name."""
    cal = calendar(F.col("createdAt"))
    named = activity.join(users.select(F.col("id").alias("userId"), "userName"), "userId", "left")
    return named.withColumns({"date": cal["date"], "week": cal["week"], "year": cal["year"]})


def on_page(activity: DataFrame, page: str) -> DataFrame:
    return activity.where(F.col("pageName") == page)


def weekly_active_users(activity: DataFrame) -> DataFrame:
    return activity.groupBy("week").agg(F.max("date").alias("date"), F.countDistinct("userId").alias("users"))


def queries_per_day(activity: DataFrame, action: str = QUERY_ACTION) -> DataFrame:
    return activity.where(F.col("actionType") == action).groupBy("date").agg(F.count("*").alias("queries"))


def recent_weeks(activity: DataFrame, weeks: int = RECENT_WEEKS) -> DataFrame:
    """Rows of the last week and the `weeks` before it; the last week is a scalar sub-query."""
    latest = activity.agg(F.max("week"))
    return activity.where(F.col("week") >= latest.scalar() - weeks)


def user_week_days(activity: DataFrame) -> DataFrame:
    """Distinct active days per named user and week."""
    days = activity.where(F.col("userName").isNotNull()).groupBy("userName", "year", "week")
    return days.agg(F.countDistinct("date").alias("num_days")).withColumn(
        "week_label", week_label(F.col("year"), F.col("week")))


def heatmap(days: DataFrame, labels: tuple[str, ...] = ()) -> DataFrame:
    """User by week, missing weeks 0, week columns in text order.

    Every week of the data is a column, and so are the weeks in `labels`. The weeks of the data are looked up first:
    after `recent_weeks` there are at most `RECENT_WEEKS` + 1 a year.
    """
    there = [r[0] for r in days.select("week_label").distinct().collect()]
    return days.groupBy("userName").pivot("week_label", sorted({*there, *labels})).agg(F.first("num_days")).fillna(0)


def weekly_users_before_last(activity: DataFrame) -> DataFrame:
    """Distinct users per week without the last, unfinished week."""
    latest = activity.agg(F.max("week"))
    return activity.where(F.col("week") < latest.scalar()).groupBy("week").agg(
        F.countDistinct("userId").alias("users"))


def top_users(activity: DataFrame, n: int = TOP_USERS) -> DataFrame:
    """The `n` busiest users of each week; equal counts in user order."""
    counts = activity.groupBy("week", "userId").agg(F.count("*").alias("uses"))
    w = Window.partitionBy("week").orderBy(F.col("uses").desc(), "userId")
    return counts.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def frequent_top_users(top: DataFrame, above: int = ACTIVE_ABOVE) -> DataFrame:
    return top.groupBy("userId").agg(F.count("*").alias("weeks_in_top")).where(F.col("weeks_in_top") > above)


def inactive_users(activity: DataFrame, below: int = INACTIVE_BELOW) -> DataFrame:
    return activity.groupBy("userId").agg(F.count("*").alias("uses")).where(F.col("uses") < below)


def weekly_query_counts(activity: DataFrame, query: str) -> DataFrame:
    """Use of each query per week, most used first within a week."""
    return activity.groupBy("week", query).agg(F.count("*").alias("uses")).orderBy("week", F.desc("uses"), query)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), column)


def share_of_total(counts: DataFrame, value: str = "n") -> DataFrame:
    """Percent of the grand total, which is a scalar sub-query rather than a one-task window."""
    total = counts.agg(F.sum(value))
    return counts.withColumn("percent", F.round(F.lit(100.0) * F.col(value) / total.scalar(), 1))


def metric_sums(port: DataFrame, metrics: list[str]) -> DataFrame:
    """Sum of each metric per table, total rows left out."""
    return port.where(~F.col("is_total")).groupBy("table_id").agg(*[F.sum(m).alias(m) for m in metrics])


def provider_overlap(companies: DataFrame, name: str, key_a: str, key_b: str) -> DataFrame:
    """Names known only to A, only to B, and to both: one aggregate instead of a join of two sets."""
    per_name = companies.where(F.col(name).isNotNull()).groupBy(name).agg(
        F.max(F.col(key_a).isNotNull()).alias("a"), F.max(F.col(key_b).isNotNull()).alias("b"))
    return per_name.agg(
        F.count_if(F.col("a") & ~F.col("b")).alias("only_a"),
        F.count_if(~F.col("a") & F.col("b")).alias("only_b"),
        F.count_if(F.col("a") & F.col("b")).alias("both"),
    )


def numeric_profile(df: DataFrame, column: str, accuracy: int = 100_000) -> DataFrame:
    """count, mean, std, min, exact quartiles (linear between neighbours) and max of one column, as one row.

    A quantile sketch brackets each quartile, equal values are counted together, and only the narrow brackets
    are ranked, slice by slice: no task sees all values, and the result is exact. The sketch errs by at most n / accuracy ranks.
    """
    v = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    points = [0.25, 0.5, 0.75]
    probes = [min(max(p + side * 3.0 / accuracy, 0.0), 1.0) for p in points for side in (-1, 1)]
    whole = v.agg(
        F.count("*").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.percentile_approx("v", probes, accuracy).alias("probe"),
    )
    counted = v.groupBy("v").agg(F.count("*").alias("n"))

    def bound(i: int) -> Column:
        return whole.select(F.col("probe")[i]).scalar()

    below = counted.agg(*[
        F.coalesce(F.sum(F.when(F.col("v") < bound(2 * i), F.col("n"))), F.lit(0)).alias(f"below{i}")
        for i in range(len(points))])
    # a bracket is ranked in slices of its value range: slice totals first, then inside each slice
    inside = Window.partitionBy("slice").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES rows
    near = []
    for i, p in enumerate(points):
        lo, hi = bound(2 * i), bound(2 * i + 1)
        share = F.when(hi > lo, (F.col("v") - lo) / (hi - lo)).otherwise(0.0)
        bracket = counted.where(F.col("v").between(lo, hi)).withColumn("slice", F.floor(share * (SLICES - 1)))
        before = bracket.groupBy("slice").agg(F.sum("n").alias("n")).select(
            "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
        ranked = bracket.join(before, "slice").withColumn(
            "upto", F.sum("n").over(inside) + F.col("before") + below.select(f"below{i}").scalar())
        rank = F.lit(p) * (whole.select("count").scalar() - 1)
        near.append(ranked.select(F.lit(i).alias("q"), "v", "upto", rank.alias("rank")))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    picked = near[0].unionByName(near[1]).unionByName(near[2]).groupBy("q", "rank").agg(
        at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"))
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    quartiles = picked.withColumn("value", value).agg(
        *[F.max(F.when(F.col("q") == i, F.col("value"))).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    one = whole.drop("probe").withColumn("one", F.lit(1))
    return one.join(quartiles.withColumn("one", F.lit(1)), "one").drop("one").select(
        "count", "mean", "std", "min", "q25", "q50", "q75", "max")
