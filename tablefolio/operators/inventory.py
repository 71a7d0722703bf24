"""Report inventory: folders and reports, fund attributes, periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablefolio.functions.texts import drop_link_line, path_part, report_quarter, report_year

# The report ending and the review limits. Where folders lie differs from site to site: parameters.
REPORT_ENDING = ".pdf"
REJECTED = "Rejected"
MODIFIED_AFTER = "2022-01-01"
ATTRIBUTES = ("GP", "Stage", "Year", "Geo")
OUTPUT_NAMES = {
    "ReportName": "report_name", "Name": "fund_name", "GP": "gp", "Stage": "stage", "Year": "year", "Geo": "geo",
    "Modified": "modified", "Modified By": "modified_by", "Doc Type": "report_type", "Path": "path",
}


def funds(inventory: DataFrame, folder: str) -> DataFrame:
    """Fund folders, which lie in `folder`: Name and the four attributes."""
    return inventory.where(F.col("Path") == folder).select("Name", *ATTRIBUTES)


def reports(inventory: DataFrame, folder: str, fund_in_path: str) -> DataFrame:
    """Report files below any `folder` with their clean name and the fund, which the first group of `fund_in_path` finds
    in their path."""
    found = inventory.where(F.contains("Path", F.lit(folder)))
    found = found.withColumn("Name", F.col("Name").cast("string")).where(F.endswith("Name", F.lit(REPORT_ENDING)))
    return found.withColumns({"ReportName": drop_link_line(F.col("Name")),
                              "FundName": path_part(F.col("Path"), fund_in_path)}).drop("Name")


def enrich(reports_df: DataFrame, funds_df: DataFrame) -> DataFrame:
    """Reports with their fund; an attribute missing on the report comes from the fund."""
    fund = funds_df.select("Name", *[F.col(a).alias(f"fund_{a}") for a in ATTRIBUTES])
    joined = reports_df.join(fund, reports_df["FundName"] == fund["Name"], "left")
    filled = joined.withColumns({a: F.coalesce(F.col(a), F.col(f"fund_{a}")) for a in ATTRIBUTES})
    return filled.select(*[F.col(f"`{old}`").alias(new) for old, new in OUTPUT_NAMES.items()])


def current(enriched: DataFrame, after: str = MODIFIED_AFTER) -> DataFrame:
    """Not rejected (an unknown stage stays) and modified after the day."""
    return enriched.where(~F.col("stage").eqNullSafe(REJECTED) & (F.col("modified") > F.lit(after)))


def with_period(enriched: DataFrame) -> DataFrame:
    """Replace the year by the one in the report name and add the quarter."""
    return enriched.withColumns({"year": report_year(F.col("report_name")),
                                 "quarter": report_quarter(F.col("report_name"))})


def without_period(reports_df: DataFrame) -> DataFrame:
    return reports_df.where(F.col("quarter").isNull() | F.col("year").isNull())


def with_labels(companies: DataFrame, labels: DataFrame, key: str, drop: tuple[str, ...] = (),
                drop_label: tuple[str, ...] = ()) -> DataFrame:
    """Left join of labels by name after dropping columns no longer needed."""
    return companies.drop(*drop).join(labels.drop(*drop_label), key, "left")


def in_list(companies: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Companies whose name is in the list: a semi join instead of a generated IN text."""
    return companies.join(names, key, "left_semi")


