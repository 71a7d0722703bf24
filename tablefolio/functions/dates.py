"""Calendar fields and value bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels, with the inclusive upper bound of each band; the last band is open.
RECENCY_BANDS = (
    (90, "Last 3 months"), (180, "Last 6 months"), (365, "Last 1 year"), (730, "Last 2 years"),
    (None, "2+ years"),
)
REVENUE_BANDS = (
    (50, "Small Business (less than 50M)"), (200, "Mid-Small Business (less than 200M)"),
    (1000, "Mid-market company (less than 1B)"), (None, "Large company (1B+)"),
)


def calendar(ts: Column) -> dict[str, Column]:
    """Date, ISO week and calendar year of a timestamp."""
    return {"date": F.to_date(ts), "week": F.weekofyear(ts), "year": F.year(ts)}


def week_label(year: Column, week: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-W"), week.cast("string"))


def _band(value: Column, bands: tuple) -> Column:
    out = None
    for upper, label in bands:
        test = value.isNotNull() if upper is None else value <= upper
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def recency_band(day: Column, as_of: Column) -> Column:
    """Band of the days between `day` and `as_of`; the same day and later days -> null."""
    age = F.datediff(as_of, day)
    return F.when(age > 0, _band(age, RECENCY_BANDS))


def revenue_band(revenue: Column) -> Column:
    """Revenue band; null stays null."""
    return _band(revenue, REVENUE_BANDS)
