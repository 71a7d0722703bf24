"""Metrics, their column rules, and reading such rules from a JSON file."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

METHODS = ("Match", "Contain")
CONFLICTS = ("KeepLast", "KeepMost")


class RuleFileError(ValueError):
    """The rule file lacks a required field or names an unknown method or conflict."""


@dataclass(frozen=True)
class ColumnRule:
    """One way to recognise a column, by its name or by its values."""

    patterns: tuple[str, ...]
    method: str
    priority: int
    exclude: tuple[str, ...] = ()
    conflict: str | None = None
    regex: bool = False
    on_values: bool = False
    threshold: int = 0

    def __post_init__(self):
        if self.method not in METHODS:
            raise RuleFileError(f"ERR-ID1004 unknown method {self.method}")
        if self.conflict not in (None, *CONFLICTS):
            raise RuleFileError(f"unknown conflict {self.conflict}")


@dataclass(frozen=True)
class Metric:
    """A target column: fixed position, or rules tried in order."""

    name: str
    rules: tuple[ColumnRule, ...] = ()
    position: int | None = None


@dataclass(frozen=True)
class RuleSet:
    metrics: tuple[Metric, ...] = field(default_factory=tuple)

    def names(self) -> list[str]:
        return [m.name for m in self.metrics]

    def phrases(self, targets: tuple[str, ...], several_words: bool = False) -> list[tuple[str, str]]:
        """(metric, lower-case phrase) of the plain name rules, in rule order."""
        return [
            (m.name, p.lower())
            for m in self.metrics if m.name in targets
            for r in m.rules if not r.on_values and not r.regex
            for p in r.patterns if not several_words or len(p.split()) > 1
        ]


def _by_name(priority: int, method: str, *patterns: str, **more) -> ColumnRule:
    return ColumnRule(tuple(patterns), method, priority, **more)


# The eleven metrics in processing order, each with its column rules.
DEFAULT_RULES = RuleSet((
    Metric("ownership", (_by_name(1, "Contain", "own", "% holding", "Percentage of Equity Interest"),)),
    Metric("company_name", position=0),
    Metric("security_type", (
        _by_name(1, "Contain", "Security Type"),
        _by_name(1, "Contain", "Preferred", "Common", "Series", on_values=True, threshold=5),
    )),
    Metric("investment_date", (_by_name(1, "Contain", "Date"),)),
    Metric("gross_moic", (
        _by_name(1, "Contain", "Gross MOIC", "Investment Multiple", "Gross Multiple"),
        _by_name(2, "Contain", "MOIC", "Multiple"),
    )),
    Metric("total_cost", (
        _by_name(1, "Match", "Total Cost", "Total Invested", "Total Basis", "Total Investment", "Capital Invested"),
        _by_name(1, "Match", "Cost"),
        _by_name(2, "Contain", "Cost", "Invested", "Basis", "Cumulative Investment", conflict="KeepMost"),
    )),
    Metric("shares", (_by_name(1, "Contain", "Securities", "Shares", "Equity"),)),
    Metric("gross_irr", (
        _by_name(1, "Contain", "Investment IRR", "Gross IRR"),
        _by_name(2, "Contain", "IRR"),
    )),
    Metric("unrealized_value", (
        _by_name(1, "Match", "Fair Value", "FV", "FMV", "Total Unrealized", "Valuation", "Unrealized Value",
                 "Market Value", "Carrying Value", "Unrealized", "Total Estimated Fair Value",
                 exclude=("Change",), conflict="KeepLast"),
        _by_name(2, "Contain", "Fair Value", "FV", "FMV", "Total Unrealized", "Valuation", "Unrealized Value",
                 "Market Value", "Carrying Value", "Unrealized Gain", exclude=("Change",), conflict="KeepLast"),
    )),
    Metric("realized_value", (
        _by_name(1, "Contain", "Proceeds", "Realized Value", "Amount Realized", "Valuation Realized"),
        _by_name(2, "Match", "Realized"),
    )),
    Metric("total", (
        _by_name(1, "Match", "Total", "Total Value", "Total Realized .* Unrealized .*", regex=True),
        _by_name(1, "Contain", "Total Value"),
        _by_name(2, "Contain", "Total", exclude=("Cost", "Fair Value"), conflict="KeepLast"),
    )),
))

# Metric columns that hold text, fractions, and the five metrics used to spot table headers.
TEXT_METRICS = ("company_name", "security_type", "investment_date")
PERCENT_METRICS = ("ownership", "gross_irr")
NUMBER_METRICS = tuple(n for n in DEFAULT_RULES.names() if n not in TEXT_METRICS)
HEADER_METRICS = ("total_cost", "unrealized_value", "realized_value", "total", "gross_moic")
CARRY_METRICS = ("ownership", "total_cost", "unrealized_value", "realized_value", "gross_moic")


def _read_rule(raw: dict, on_values: bool) -> ColumnRule:
    missing = [k for k in ("Patterns", "Method", "Priority") if k not in raw]
    if missing:
        raise RuleFileError(f"ERR-ID1003 missing {missing}")
    return ColumnRule(
        tuple(raw["Patterns"]), raw["Method"], raw["Priority"], tuple(raw.get("Exclude", ())),
        raw.get("Conflict"), bool(raw.get("isRegex")), on_values, raw.get("Threshold", 0),
    )


def read_rules(path: str) -> RuleSet:
    """Rules from a JSON file; the order of its keys is the order in which metrics take their columns."""
    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    return RuleSet(tuple(
        Metric(
            name,
            tuple(_read_rule(r, False) for r in body.get("ColumnNamePattern", ()))
            + tuple(_read_rule(r, True) for r in body.get("ColumnValuePattern", ())),
            body.get("ColumnIndex"),
        )
        for name, body in raw.items()
    ))
