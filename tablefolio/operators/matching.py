"""Rule-driven choice of one source column per metric, for all tables at once.

Metrics take their columns one after the other and a taken column is gone for the next metric. The choice is a
fold over the metrics inside one row per table, on the columns' names and counts; no row data takes part.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.operators.headers import (
    FILLED, INVALID_TABLE, LAYER_WIDE, MIN_COLUMNS, MONEY, MONEY_SUM, NUMBER, VALUE_RULES, drop_marks,
)
from tablefolio.operators.ordered import settled
from tablefolio.rules import DEFAULT_RULES, ColumnRule, RuleSet

P1_MULTI = "ERR-ID1002"
P2_MULTI = "WRN-ID2003"
RULE_TYPE = "struct<id:int,label:string,conflict:string,on_values:boolean>"
COLUMN_TYPE = "struct<col_idx:int,name:string,stats:array<double>,hits:array<boolean>>"
PICK_TYPE = "struct<metric:string,col_idx:int,src:string,rule:string,stats:array<double>>"


def name_matches(name: Column, rule: ColumnRule) -> Column:
    """Does a column name satisfy a name rule?"""
    low = F.lower(name)
    patterns = [p.lower() for p in rule.patterns]
    if rule.method == "Contain":
        hit = low.rlike("(?i)" + "|".join(patterns))
    elif rule.regex:
        return name.rlike("(?i)^(?:" + "|".join(patterns) + ")$")
    else:
        hit = low.isin(*patterns)
    if rule.exclude and not rule.regex:
        hit = hit & ~low.rlike("(?i)" + "|".join(e.lower() for e in rule.exclude))
    return hit


def _let(value: Column, body) -> Column:
    """Bind a value once inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _flat_rules(rules: RuleSet) -> list[ColumnRule]:
    return [r for m in rules.metrics for r in m.rules]


def keep_last(columns: Column) -> Column:
    return F.slice(columns, -1, 1)


def keep_most(columns: Column) -> Column:
    """The column with most numbers; on a tie the one with the largest sum among all matched columns."""
    most = F.array_max(F.transform(columns, lambda c: c["stats"][MONEY]))
    largest = F.array_max(F.transform(columns, lambda c: c["stats"][MONEY_SUM]))
    top = F.filter(columns, lambda c: c["stats"][MONEY] == most)
    by_sum = F.filter(columns, lambda c: c["stats"][MONEY_SUM] == largest)
    return F.when(F.size(top) == 1, top).otherwise(F.slice(by_sum, 1, 1))


def _settle(found: Column, rule: Column) -> Column:
    """Apply the rule's way to settle several matches; several matches of a value rule count as none."""
    several = F.size(found) > 1
    return (F.when(several & rule["on_values"], F.slice(found, 1, 0))
            .when(several & (rule["conflict"] == "KeepLast"), keep_last(found))
            .when(several & (rule["conflict"] == "KeepMost"), keep_most(found))
            .otherwise(found))


def _metric_list(rules: RuleSet) -> Column:
    flat = {id(r): i for i, r in enumerate(_flat_rules(rules))}
    listed = []
    for m in rules.metrics:
        turns = ([(r, "P1") for r in m.rules if not r.on_values and r.priority == 1]
                 + [(r, "P1") for r in m.rules if r.on_values]
                 + [(r, "P2") for r in m.rules if not r.on_values and r.priority == 2])
        entries = [F.struct(F.lit(flat[id(r)]).alias("id"), F.lit(label).alias("label"),
                            F.lit(r.conflict).cast("string").alias("conflict"),
                            F.lit(r.on_values).alias("on_values")) for r, label in turns]
        listed.append(F.struct(F.lit(m.name).alias("metric"), F.lit(m.position).cast("int").alias("position"),
                               F.array(*entries).cast(f"array<{RULE_TYPE}>").alias("rules")))
    return F.array(*listed)


@lru_cache(maxsize=16)
def _fold(rules: RuleSet) -> Column:
    """The fold over the metrics as one expression on `columns` and `code`; built once per rule set."""
    value_place = 0
    tests = []
    for r in _flat_rules(rules):
        if r.on_values:
            place = VALUE_RULES + value_place
            value_place += 1
            tests.append(lambda c, place=place, least=r.threshold: c["stats"][place] >= least)
        else:
            tests.append(lambda c, r=r: name_matches(c["name"], r))

    def with_hits(c: Column) -> Column:
        return F.struct(c["col_idx"], c["name"], c["stats"], F.array(*[t(c) for t in tests]).alias("hits"))

    start = F.struct(
        F.transform("columns", with_hits).cast(f"array<{COLUMN_TYPE}>").alias("left"),
        F.array().cast(f"array<{PICK_TYPE}>").alias("picks"),
        F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("detail"))

    def step(acc: Column, m: Column) -> Column:
        def by_rule(r: Column) -> Column:
            found = F.filter(acc["left"], lambda c: F.get(c["hits"], r["id"]))
            return F.struct(_settle(found, r).alias("columns"), r["label"].alias("label"))

        options = F.filter(F.transform(m["rules"], by_rule), lambda o: F.size(o["columns"]) > 0)
        by_place = F.struct(F.slice(acc["left"], m["position"] + 1, F.lit(1)).alias("columns"),
                            F.lit("P1").alias("label"))
        choice = F.when(m["position"].isNotNull(), by_place).otherwise(F.get(options, F.lit(0)))

        def take(o: Column) -> Column:
            chosen = F.get(o["columns"], F.lit(0))
            namesakes = F.size(F.filter(acc["left"], lambda c: c["name"] == chosen["name"]))
            clash = m["position"].isNull() & ((F.size(o["columns"]) > 1) | (namesakes > 1))
            pick = F.struct(m["metric"].alias("metric"), chosen["col_idx"].alias("col_idx"),
                            chosen["name"].alias("src"), o["label"].alias("rule"), chosen["stats"].alias("stats"))
            return F.when(chosen.isNull(), acc).when(clash, F.struct(
                acc["left"].alias("left"), acc["picks"].alias("picks"),
                F.when(o["label"] == "P1", F.lit(P1_MULTI)).otherwise(F.lit(P2_MULTI)).alias("code"),
                m["metric"].alias("detail"),
            )).otherwise(F.struct(
                F.filter(acc["left"], lambda c: c["name"] != chosen["name"]).alias("left"),
                F.concat(acc["picks"], F.array(pick)).alias("picks"), acc["code"].alias("code"),
                acc["detail"].alias("detail")))

        return F.when(acc["code"].isNotNull(), acc).otherwise(_let(choice, take))

    return F.when(F.col("code").isNull(), F.aggregate(_metric_list(rules), start, step))


def assign_columns(tables: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Add `picks` (metric, col_idx, src, rule) and the final `code` and `detail` to repaired headers."""
    folded = tables.withColumn("fold", _fold(rules))
    company = F.get(F.filter("fold.picks", lambda p: p["metric"] == "company_name"), F.lit(0))["stats"]
    has_security = F.exists("fold.picks", lambda p: p["metric"] == "security_type")
    wide = F.exists("fold.picks", lambda p: p["stats"][LAYER_WIDE] > 0)
    out = folded.withColumns({
        "has_security": F.coalesce(has_security, F.lit(False)),
        "hidden_security": F.coalesce(~has_security & wide, F.lit(False)),
        "has_ownership": F.coalesce(F.exists("fold.picks", lambda p: p["metric"] == "ownership"), F.lit(False)),
        "company_is_text": F.coalesce(company[NUMBER] < company[FILLED], F.lit(False)),
    })
    code = (F.when(F.col("code").isNotNull(), F.col("code")).when(F.col("fold.code").isNotNull(), F.col("fold.code"))
            .when(F.size("fold.picks") < MIN_COLUMNS, F.lit(INVALID_TABLE))
            .when(~F.col("has_security") & ~F.col("company_is_text"), F.lit(INVALID_TABLE)))
    return settled(out.withColumns({
        "code": code, "detail": F.col("fold.detail"),
        "picks": F.transform("fold.picks", lambda p: F.struct(p["metric"], p["col_idx"], p["src"], p["rule"])),
    }).drop("fold", "columns"))


def lineage(assigned: DataFrame) -> DataFrame:
    """One row per chosen column of the admitted tables: table_id, target, src, rule."""
    picked = assigned.where("code IS NULL").select("table_id", F.explode("picks").alias("p"))
    return picked.select("table_id", F.col("p.metric").alias("target"), "p.src", "p.rule")


def metric_places(assigned: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """The admitted tables with the source position of each metric in a column of its own (`at_<metric>`)."""
    by_metric = F.map_from_entries(F.transform("picks", lambda p: F.struct(p["metric"], p["col_idx"])))
    admitted = assigned.where("code IS NULL").withColumn("places", by_metric)
    places = [F.try_element_at("places", F.lit(m)).alias(f"at_{m}") for m in rules.names()]
    return settled(admitted.select("table_id", "n_rows", "skip", "first_col", "merged", "has_security",
                                   "hidden_security", "has_ownership", *places))


@lru_cache(maxsize=16)
def metric_texts(rules: RuleSet = DEFAULT_RULES) -> list[Column]:
    """For rows joined with `metric_places`: the text of each metric, null where it has no column."""
    def text(metric: str) -> Column:
        at = F.col(f"at_{metric}")
        own = F.get("values", at)
        folded = F.col("merged") & (at == F.col("first_col"))
        return drop_marks(F.when(folded, F.coalesce(F.get("values", at + 1), own)).otherwise(own)).alias(metric)

    return [text(m) for m in rules.names()]


def last_containing(names: Column, patterns: tuple[str, ...]) -> Column:
    """Last name that contains any pattern, or null."""
    found = F.filter(names, lambda n: F.lower(n).rlike("(?i)" + "|".join(p.lower() for p in patterns)))
    return F.try_element_at(found, F.lit(-1))
