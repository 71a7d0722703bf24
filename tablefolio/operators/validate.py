"""Accounting checks and the filling of single missing values, with lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.operators.ordered import settled

SUM_METRICS = ("total", "realized_value", "unrealized_value")
MULTIPLE_METRICS = ("total", "total_cost", "gross_moic")


def _missing(columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def _same(a: Column, b: Column, tolerance: float) -> Column:
    return a == b if tolerance == 0 else F.abs(a - b) <= tolerance


def validate_metrics(df: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Add `is_validated` and `filled_metrics`, and solve for a value that is the only one missing.

    First total = realized + unrealized, then, on the values so filled, gross_moic = total / total_cost.
    Division by zero gives null. Everything is row-local.
    """
    total, realized, unrealized = (F.col(c) for c in SUM_METRICS)
    cost, moic = F.col("total_cost"), F.col("gross_moic")

    def alone(count: str, column: str, value: Column) -> Column:
        return F.when((F.col(count) == 1) & F.col(column).isNull(), value).otherwise(F.col(column))

    def target(count: str, column: str) -> Column:
        return F.when((F.col(count) == 1) & F.col(column).isNull(), F.lit(column))

    step = df.withColumns({
        "__n": _missing(SUM_METRICS),
        "is_validated": F.when(_missing(SUM_METRICS) == 0, _same(total, realized + unrealized, tolerance)),
    })
    step = step.withColumns({
        "__sum_fill": F.array_compact(F.array(*[target("__n", c) for c in SUM_METRICS])),
        "total": alone("__n", "total", realized + unrealized),
        "realized_value": alone("__n", "realized_value", total - unrealized),
        "unrealized_value": alone("__n", "unrealized_value", total - realized),
    })
    step = step.withColumn("__m", _missing(MULTIPLE_METRICS))
    step = step.withColumns({
        "is_validated": F.when(
            F.col("__m") == 0,
            F.coalesce(F.col("is_validated"), F.lit(False))
            & F.coalesce(_same(moic, F.try_divide(total, cost), tolerance), F.lit(False)),
        ).otherwise(F.col("is_validated")),
        "filled_metrics": F.concat(
            "__sum_fill", F.array_compact(F.array(*[target("__m", c) for c in MULTIPLE_METRICS]))),
        "total": alone("__m", "total", moic * cost),
        "total_cost": alone("__m", "total_cost", F.try_divide(total, moic)),
        "gross_moic": alone("__m", "gross_moic", F.try_divide(total, cost)),
    })
    return step.drop("__n", "__m", "__sum_fill")


def filled_lineage(validated: DataFrame, *keys: str) -> DataFrame:
    """One row per filled value: keys, target, rule `VA`."""
    filled = settled(validated.select(*keys, "filled_metrics"))
    return filled.select(*keys, F.explode("filled_metrics").alias("target"), F.lit("VA").alias("rule"))


def failed_rows(validated: DataFrame, *keys: str) -> DataFrame:
    """Error rows for records whose identities do not hold."""
    from tablefolio.operators.errors import error_row

    return validated.where(~F.col("is_validated")).select(*keys, *error_row("WRN-VA2001"))
