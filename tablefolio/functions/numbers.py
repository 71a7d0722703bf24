"""Money, percent and plain-number parsing. Bad input gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
NUMBER_PATTERN = rf"^\s*({_NUMBER})\s*$"


def is_number(text: Column) -> Column:
    """True for a plain decimal number with optional blanks around it; null stays null."""
    return text.rlike(NUMBER_PATTERN)


def to_number(text: Column) -> Column:
    """Plain number or null. The pattern guards against forms Spark's cast takes (`12d`)."""
    return F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double")


def _bracket_minus(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("(")), F.regexp_replace(text, r"\((.+?)\)", "-$1")).otherwise(text)


def parse_money(text: Column) -> Column:
    """`$1,234` -> 1234, `(191)` -> -191, `3.8x` -> 3.8, `-` -> null."""
    return to_number(_bracket_minus(F.translate(text, "$,x", "")))


def parse_percent(text: Column) -> Column:
    """`78.7%` -> 0.787, `(3.5)%` -> -0.035; a value without a percent sign -> null."""
    bare = F.regexp_replace(text, r"[%\[\]·]", "")
    return F.when(F.contains(text, F.lit("%")), to_number(_bracket_minus(bare)) / 100)


def is_amount_text(text: Column) -> Column:
    """True when a text span is a number once `$` and `,` are removed."""
    return F.coalesce(is_number(F.regexp_replace(text, "[$,]", "")), F.lit(False))


def to_id(text: Column) -> Column:
    """Numeric coercion to a whole id; anything that is not a number -> null."""
    return to_number(text).try_cast("bigint")
