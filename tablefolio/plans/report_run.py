"""Numbered report pages and the tables found on them -> facts, lineage and errors by fund and table file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefolio.operators.grid import registry_for_tables
from tablefolio.operators.pages import batch_id
from tablefolio.plans.portfolio import build_portfolio
from tablefolio.rules import DEFAULT_RULES, RuleSet
from tablefolio.session import written
from tablefolio.sources.sinks import write_table_files

REPORT = ("fund_name", "report_name", "csv_path")


@dataclass(frozen=True)
class ReportRun:
    """`registry` has a row per table that was found on a known page; the others carry its fund, report and file."""

    registry: DataFrame
    facts: DataFrame
    lineage: DataFrame
    errors: DataFrame


def processed_path(folder: str, paths: Column) -> Column:
    """Where the kept pages of a batch of reports, given as an array of their paths, are put together."""
    return F.concat(F.lit(folder.rstrip("/") + "/report_"), batch_id(paths), F.lit(".pdf"))


def total_matches() -> Column:
    """Whether unrealized and realized value make up the total that the table itself gives; null without one."""
    return F.when(~F.array_contains("filled_metrics", "total"), F.col("total_exp") == F.col("total"))


def run_reports(pages: DataFrame, tables: DataFrame, headers: DataFrame, rows: DataFrame,
                rules: RuleSet = DEFAULT_RULES) -> ReportRun:
    """From the page registry to facts that know their fund.

    pages: rows of `number_pages` and `processed_report_path`. tables: table_id, processed_report_path, page_new,
    table_ord, a row for each table that was recognised. headers and rows as for `build_portfolio`. The registry is a
    small record per table, written once; facts, lineage and errors meet it by table. A table on a page that the
    registry does not know keeps its facts, without a fund. A table without a readable header is an error under its own
    file name.
    """
    registry = written(registry_for_tables(tables, pages.where("is_processed")), "table-registry")
    built = build_portfolio(headers, rows, rules, expected=tables)
    report = registry.select("table_id", *REPORT)

    def of_report(df: DataFrame) -> DataFrame:
        return df.join(report, "table_id", "left").select(*REPORT, *df.columns)

    return ReportRun(registry, of_report(built.facts).withColumn("total_matches", total_matches()),
                     of_report(built.lineage), of_report(built.errors))


def write_run(run: ReportRun, headers: DataFrame, rows: DataFrame, path: str) -> None:
    """Facts, lineage and errors as Parquet below a folder per fund, and each table as a CSV file of its fund.

    Facts are dealt by table, so a large fund is written by many tasks. Tables without a fund are left out of the CSV files.
    """
    for name in ("facts", "lineage", "errors"):
        df = getattr(run, name)
        df.repartition("fund_name", "table_id").write.mode("overwrite").partitionBy("fund_name").parquet(f"{path}/{name}")
    fund = run.registry.select("table_id", "fund_name")
    write_table_files(headers.join(fund, "table_id"), rows.join(fund, "table_id"), f"{path}/tables")
