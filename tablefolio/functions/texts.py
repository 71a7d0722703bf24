"""Report-name and path text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period marks looked for in report names.
YEAR_PATTERN = "(20[1-2][0-9])"
QUARTER_PATTERN = "(Q[1-4])"
HALF_YEAR_MARK = "06."


def last_match(text: Column, pattern: str) -> Column:
    """Last match of the first group, or null."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))


def report_year(name: Column) -> Column:
    """Last year 2010-2029 in the name."""
    return last_match(name, YEAR_PATTERN)


def report_quarter(name: Column) -> Column:
    """Last `Qn` in the name; otherwise Q2 when the half-year mark occurs."""
    return F.coalesce(last_match(name, QUARTER_PATTERN), F.when(name.rlike(HALF_YEAR_MARK), F.lit("Q2")))


def path_part(path: Column, pattern: str) -> Column:
    """First group of the pattern, or null."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def drop_link_line(name: Column) -> Column:
    """Remove a leading link line, for names that start with one."""
    text = name.cast("string")
    return F.when(F.startswith(text, F.lit("http")), F.regexp_replace(text, "http.*\n", "")).otherwise(text)


def relabel(text: Column, old: str = "Consumer / Retail", new: str = "Consumer") -> Column:
    """Replace a sub-string of a label."""
    return F.replace(text, F.lit(old), F.lit(new))


def contains_any(text: Column, phrases: list[str] | tuple[str, ...]) -> Column:
    """True when any phrase occurs literally."""
    hit = F.lit(False)
    for p in phrases:
        hit = hit | F.contains(text, F.lit(p))
    return hit
