"""Headers and rows of all tables -> portfolio facts, column lineage and errors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio import schemas
from tablefolio.operators import rows as R
from tablefolio.operators.errors import describe, error_row
from tablefolio.operators.headers import INVALID_TABLE, repair_headers, table_profiles
from tablefolio.operators.matching import assign_columns, lineage, metric_places, metric_texts
from tablefolio.operators.ordered import SEGMENT_ROWS, RowOrder
from tablefolio.operators.validate import filled_lineage, validate_metrics
from tablefolio.rules import DEFAULT_RULES, NUMBER_METRICS, RuleSet
from tablefolio.session import durable
from tablefolio.sources.csv_tables import unreadable

EARLY_NUMBERS = [m for m in NUMBER_METRICS if m != "ownership"]
TASK_ROWS = 1 << 17  # rows that a task sorts, where there are enough of them for all cores


@dataclass(frozen=True)
class Portfolio:
    facts: DataFrame
    lineage: DataFrame
    errors: DataFrame


def decide_tables(headers: DataFrame, rows: DataFrame, rules: RuleSet = DEFAULT_RULES, trim: bool = True) -> DataFrame:
    """One row per table: admitted or the error code, and the chosen columns."""
    return assign_columns(repair_headers(table_profiles(headers, rows, rules), rules, trim), rules)


def metric_rows(rows: DataFrame, decided: DataFrame, rules: RuleSet = DEFAULT_RULES,
                segment_rows: int = SEGMENT_ROWS, partitions: int | None = None) -> DataFrame:
    """Rows of the admitted tables with one text column per metric; `row_idx` counts data rows from 0.

    The join key is the table and the segment (`part`) of the row, so the rows of a huge table go to many tasks; the
    decision of a table is repeated once per segment, which for nearly all tables is once. `partitions` fixes their
    number; else Spark chooses it by the size of the compressed rows.
    """
    places = metric_places(decided, rules)
    last = F.floor((F.col("n_rows") - 1) / segment_rows)
    repeated = places.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    keyed = rows.withColumn("part", F.floor(F.col("row_idx") / segment_rows))
    if partitions:
        keyed = keyed.repartition(partitions, "table_id", "part")
    joined = keyed.join(repeated, ["table_id", "part"]).where(F.col("row_idx") >= F.col("skip"))
    return joined.select(
        "table_id", "part", (F.col("row_idx") - F.col("skip")).alias("row_idx"), "n_rows", "has_security",
        "hidden_security", "has_ownership", *metric_texts(rules))


def normalise(df: DataFrame, order: RowOrder, rules: RuleSet = DEFAULT_RULES, drop_empty: bool = True,
              cut: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """All row operators in order. With plain windows the whole chain shares one shuffle by table."""
    segmented = order.segment_rows is not None
    layered = F.col("has_security") | F.col("hidden_security")
    first = F.when(F.col("has_ownership"), F.col("ownership")).otherwise(F.col("company_name"))
    df = R.hidden_security(cut(df), rules.names(), order, F.col("hidden_security"), first)
    # no later step reads these as texts: parsed here, rows are sorted with numbers, and filters do not parse them again
    df = R.parse_metrics(df, EARLY_NUMBERS)
    df = R.fill_company(cut(df), order, F.col("has_security"))
    if segmented:  # naming rows are gone: close the gaps before looking at neighbours
        placed = order.dense(cut(df), "__place")
        near = RowOrder(order.keys, "__place", order.segment_rows)
        df = R.subtotal_flags(placed, near, layered).drop("__place")
    else:
        df = R.subtotal_flags(df, order, layered)
    df = R.ownership_subtotals(df, layered & F.col("has_ownership"))
    df = R.parse_metrics(df, [m for m in DEFAULT_RULES.names() if m not in EARLY_NUMBERS])
    if drop_empty:
        df = R.drop_without_metrics(df)
    return R.drop_non_company(R.bottom_total(cut(df), order))


def table_sizes(decided: DataFrame) -> tuple[int, int]:
    """Rows of the largest admitted table and of all tables: two numbers from the small records that are already there."""
    admitted = F.when(F.col("code").isNull(), F.col("n_rows"))
    largest, total = decided.agg(F.max(admitted), F.sum("n_rows")).first()
    return largest or 0, total or 0


def row_partitions(spark: SparkSession, total: int, task_rows: int = TASK_ROWS) -> int | None:
    """A partition for `task_rows` rows, so that no task's memory grows with the input; none fixed where cores are more."""
    wanted = -(-total // task_rows)
    return wanted if wanted > spark.sparkContext.defaultParallelism else None


def build_portfolio(headers: DataFrame, rows: DataFrame, rules: RuleSet = DEFAULT_RULES, trim: bool = True,
                    drop_empty: bool = True, segment_rows: int = SEGMENT_ROWS,
                    cut: Callable[[DataFrame], DataFrame] = durable, expected: DataFrame | None = None) -> Portfolio:
    """The whole path from table rows to validated facts.

    Tables of up to `segment_rows` rows, nearly all of them, take plain windows and one shuffle by table. Where
    larger ones exist they take the segmented operators, so that no task gets a whole large table; their longer
    lineage is cut at checkpoints. So are the decisions, one small record per table, and the facts: the cells are
    counted once, the rows go through the operators once, and lineage and errors are read off the results. Whether
    large tables exist, and how many partitions the rows take, are two numbers from the decisions. An admitted table that is left without rows is an error
    and has no lineage. `expected` (`table_id`) adds errors for tables that could not be read at all.
    """
    decided = cut(decide_tables(headers, rows, rules, trim))
    largest, total = table_sizes(decided)
    texts = metric_rows(rows, decided, rules, segment_rows, row_partitions(rows.sparkSession, total))
    fits = F.col("n_rows") <= segment_rows
    # `part` is 0 in every table that fits: with it the windows reuse the partitioning of the join
    flagged = normalise(texts.where(fits), RowOrder(("table_id", "part"), "row_idx", None), rules, drop_empty)
    if largest > segment_rows:
        order = RowOrder(("table_id",), "row_idx", segment_rows)
        large = normalise(texts.where(~fits), order, rules, drop_empty, cut)
        flagged = flagged.unionByName(large.select(*flagged.columns))
    checked = validate_metrics(flagged.withColumn("total_exp", F.col("unrealized_value") + F.col("realized_value")))
    facts = cut(checked.select(*[c.split()[0] for c in schemas.PORTFOLIO.split(", ")]))
    filled = filled_lineage(facts, "table_id").distinct().select(
        "table_id", "target", F.lit(None).cast("string").alias("src"), "rule")
    with_rows = facts.select("table_id").distinct()
    emptied = decided.where("code IS NULL").join(with_rows, "table_id", "left_anti").select("table_id", *error_row(INVALID_TABLE))
    errors = error_rows(decided).unionByName(emptied)
    if expected is not None:
        errors = errors.unionByName(unreadable(expected, headers))
    return Portfolio(facts, lineage(decided).join(with_rows, "table_id", "left_semi").unionByName(filled), errors)


def error_rows(decided: DataFrame) -> DataFrame:
    """Error records of the rejected tables."""
    rejected = decided.where("code IS NOT NULL")
    return rejected.select("table_id", "code", *describe(F.col("code"), F.col("detail")))
