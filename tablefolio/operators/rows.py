"""Row normalisation inside each table: share classes, company names, totals, numbers.

Every operator takes a `RowOrder`, so it runs as plain windows where tables fit a task, and in segments where one
table is huge. Rows are never read in physical order; `row_idx` carries it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.functions.numbers import parse_money, parse_percent
from tablefolio.functions.texts import contains_any
from tablefolio.operators.ordered import RowOrder
from tablefolio.rules import DEFAULT_RULES, NUMBER_METRICS, PERCENT_METRICS

# Names that mark the bottom total row, words of rows that are no company, shortest company name
# that can follow a subtotal, and how many last rows may hold the total.
TOTAL_PHRASES = ("total investments", "total portfolio investments", "total portfolio", "total unrealized +",
                 "total fund")
TOTAL_NAMES = ("total", "", "totals")
NO_COMPANY = "(?i)Total|Realized"
MIN_NEXT_NAME = 4
BOTTOM_ROWS = 2
FRAGMENT_BELOW = 2

TABLE_ROWS = RowOrder(("table_id",), "row_idx")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _filled(metrics: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(m).isNotNull().cast("int") for m in metrics])


def hidden_security(df: DataFrame, metrics: list[str], order: RowOrder = TABLE_ROWS,
                    apply: Column | None = None, first_metric: Column | None = None) -> DataFrame:
    """Rows that hold one value name the company; the rows below hold its share classes.

    The company becomes `company_name`, the share class `security_type`; `total` rows stay as they are; rows
    without a name end the company. Rows before the first company and the naming rows go away.
    """
    apply = F.lit(True) if apply is None else apply
    first = F.col("company_name") if first_metric is None else first_metric
    single = _filled(metrics) == 1
    mark = (F.when(~apply, F.lit(None).cast("string"))
            .when(single, first)
            .when(F.col("company_name").isNull(), F.lit("")))
    here = df.withColumns({"__apply": apply, "__single": single, "__mark": mark})
    here = order.running(here, inclusive=False, maxima={
        "__last": F.when(F.col("__mark").isNotNull(), F.struct(F.col(order.idx), F.col("__mark").alias("mark")))})
    here = here.withColumn("__parent", F.coalesce("__last.mark", F.lit("")))
    kept = here.where(~F.col("__apply") | (~F.col("__single") & (F.col("__parent") != "")))
    name = F.coalesce("company_name", F.lit(""))
    is_total = F.contains(F.lower(name), F.lit("total"))
    had = F.col("security_type") if "security_type" in df.columns else F.lit(None).cast("string")
    return kept.withColumns({
        "security_type": F.when(~F.col("__apply"), had).when(~is_total, name),
        "company_name": F.when(~F.col("__apply"), F.col("company_name")).when(is_total, name)
        .when(F.col("company_name").isNull(), F.lit("")).otherwise(F.col("__parent")),
    }).drop("__apply", "__single", "__mark", "__last", "__parent")


def _joined(head: Column, tail: Column) -> Column:
    """The name of a group of rows from its pieces in order: those of the last row stand apart."""
    return strip(F.concat(F.array_join(head, ""), F.lit(" "), F.array_join(tail, "")))


def _group_names(here: DataFrame, order: RowOrder, named: Column) -> DataFrame:
    """Add each name group's `__from`, `__to` and `__joined`, which only its first row makes, and the table's `__last`."""
    idx = F.col(order.idx)
    group = Window.partitionBy(*order.keys, "__group")
    placed = group.orderBy(idx, named)
    whole = placed.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    here = here.withColumns({"__from": F.min(idx).over(whole), "__to": F.max(idx).over(whole),
                             "__first": F.row_number().over(placed) == 1})
    here = here.withColumns({"__head": F.collect_list(F.when(idx < F.col("__to"), named)).over(whole),
                             "__tail": F.collect_list(F.when(idx == F.col("__to"), named)).over(whole)})
    here = here.withColumn("__joined", F.when(F.col("__first"), _joined(F.col("__head"), F.col("__tail"))))
    here = here.drop("__first", "__head", "__tail").withColumn("__joined", F.max("__joined").over(group))
    return here.withColumn("__last", F.max("__group").over(Window.partitionBy(*order.keys)))


def fill_company(df: DataFrame, order: RowOrder = TABLE_ROWS, apply: Column | None = None) -> DataFrame:
    """Give security rows without a name the company above them, joining name pieces split over rows."""
    apply = F.lit(True) if apply is None else apply
    idx = F.col(order.idx)
    here = df.withColumns({"__apply": apply, "__name": F.coalesce("company_name", F.lit("")),
                           "__sec": F.coalesce("security_type", F.lit(""))})
    joins = (F.col("__sec") != "") & (F.length("__name") < FRAGMENT_BELOW)
    here = order.running(here, sums={"__group": F.when(joins, 0).otherwise(1)})
    named = F.when(F.col("__name") != "", F.col("__name"))
    if order.segment_rows is None:  # windows keep the partitions of the others: no join and no shuffle
        here = _group_names(here.dropna(subset=list(order.keys)), order, named)
    else:  # one record per name group: its joined name is made once, whatever the number of its rows
        piece = F.when(named.isNotNull(), F.struct(idx.alias("at"), named.alias("name")))
        groups = here.groupBy(*order.keys, "__group").agg(
            F.array_sort(F.collect_list(piece)).alias("__pieces"), F.min(idx).alias("__from"), F.max(idx).alias("__to"))
        head = F.transform(F.filter("__pieces", lambda p: p["at"] < F.col("__to")), lambda p: p["name"])
        tail = F.transform(F.filter("__pieces", lambda p: p["at"] == F.col("__to")), lambda p: p["name"])
        groups = groups.select(*order.keys, "__group", "__from", "__to", _joined(head, tail).alias("__joined"))
        # the last group of a table: rows of a group lie together, so it is the one with the greatest number
        last = groups.groupBy(*order.keys).agg(F.max("__group").alias("__last"))
        here = here.join(groups.join(last, list(order.keys)), [*order.keys, "__group"])
    lone_last = (F.col("__from") == F.col("__to")) & (F.col("__group") == F.col("__last"))
    joined = F.when(lone_last, F.col("__name")).otherwise(F.col("__joined"))
    return here.withColumns({
        "company_name": F.when(F.col("__apply"), joined).otherwise(F.col("company_name")),
        "security_type": F.when(F.col("__apply"), F.col("__sec")).otherwise(F.col("security_type")),
    }).drop("__apply", "__name", "__sec", "__group", "__joined", "__from", "__to", "__last")


def subtotal_flags(df: DataFrame, order: RowOrder = TABLE_ROWS, apply: Column | None = None) -> DataFrame:
    """Flag the unnamed row between a company's securities and the next company as its subtotal.

    Whether a row can be judged depends on its distance from the table end, seen by looking one to three rows
    ahead. The subtotal takes the company of the run above it. Adds `is_total`.
    """
    apply = F.lit(True) if apply is None else apply
    sec = F.coalesce("security_type", F.lit(""))
    name, exists = F.col("company_name"), F.lit(True)
    seen = order.neighbours(df.withColumn("__apply", apply), {
        "__sec1": (sec, -1), "__sec2": (sec, -2), "__name1": (name, -1), "__next": (name, 1),
        "__has1": (exists, 1), "__has2": (exists, 2), "__has3": (exists, 3)})
    after_security = F.coalesce(F.col("__sec1") != "", F.lit(False))
    after_two = after_security & F.coalesce(F.col("__sec2") != "", F.lit(False))
    at_end = {n: F.col(f"__has{n}").isNotNull() for n in (1, 2, 3)}
    judged = ((at_end[3] & (sec == ""))
              | (at_end[2] & ~at_end[3] & (after_security | (sec == "")))
              | (at_end[1] & ~at_end[2] & after_two))
    company_next = (F.length("__next") > MIN_NEXT_NAME) & ~F.contains(F.lower("__next"), F.lit("total"))
    hit = F.col("__apply") & F.coalesce((name == "") & judged & company_next, F.lit(False))
    return seen.withColumns({
        "is_total": hit,
        "company_name": F.when(hit, F.when(after_security, F.col("__name1")).otherwise(F.lit(""))).otherwise(name),
    }).drop("__apply", "__sec1", "__sec2", "__name1", "__next", "__has1", "__has2", "__has3")


def ownership_subtotals(df: DataFrame, apply: Column | None = None) -> DataFrame:
    """Without a security but with an ownership, a row is the company's total."""
    apply = F.lit(True) if apply is None else apply
    no_security = F.nullif("security_type", F.lit("")).isNull()
    owned = F.nullif("ownership", F.lit("")).isNotNull()
    return df.withColumn("is_total", F.col("is_total") | (apply & no_security & owned))


def parse_metrics(df: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Texts of the number metrics to numbers, percent metrics to fractions; empty text metrics to null."""
    def parsed(m: str) -> Column:
        if m not in NUMBER_METRICS:
            return F.nullif(m, F.lit(""))
        return parse_percent(F.col(m)) if m in PERCENT_METRICS else parse_money(F.col(m))

    return df.withColumns({m: parsed(m) for m in metrics or [*NUMBER_METRICS, *(
        n for n in DEFAULT_RULES.names() if n not in NUMBER_METRICS)]})


def drop_without_metrics(df: DataFrame, metrics: tuple[str, ...] = NUMBER_METRICS) -> DataFrame:
    """Drop rows in which no number metric is left."""
    return df.where(F.coalesce(*metrics).isNotNull())


def names_total(name: Column) -> Column:
    """The name cell of a bottom total row: empty, a total word, or a total phrase."""
    low = strip(F.lower(name))
    return name.isNull() | low.isin(*TOTAL_NAMES) | contains_any(low, TOTAL_PHRASES)


def bottom_total(df: DataFrame, order: RowOrder = TABLE_ROWS) -> DataFrame:
    """Flag the last row, or else the last but one, when its name marks a total."""
    test = F.coalesce(names_total(F.col("company_name")), F.lit(False))
    if order.segment_rows is None:
        seen = order.neighbours(df.withColumn("__test", test), {"__t1": (F.col("__test"), 1), "__t2": (F.col("__test"), 2)})
        last = F.col("__t1").isNull()
        second = F.col("__t2").isNull() & F.coalesce(~F.col("__t1"), F.lit(False))
        return seen.withColumn("is_total", F.col("is_total") | (F.col("__test") & (last | second))).drop(
            "__test", "__t1", "__t2")
    ends = order.last_rows(df.select(*order.keys, order.idx, test.alias("test")), BOTTOM_ROWS)
    flagged = ends.where("test").groupBy(*order.keys).agg(
        F.min_by(order.idx, "from_end").alias(order.idx)).withColumn("__flag", F.lit(True))
    return df.join(flagged, [*order.keys, order.idx], "left").withColumn(
        "is_total", F.col("is_total") | F.coalesce("__flag", F.lit(False))).drop("__flag")


def drop_non_company(df: DataFrame) -> DataFrame:
    """Drop rows without a company name or with a total or realized heading, unless they are flagged totals."""
    no_company = F.col("company_name").isNull() | F.col("company_name").rlike(NO_COMPANY)
    return df.where(~no_company | F.col("is_total"))
