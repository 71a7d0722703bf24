"""Errors as data: one bad table never stops the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code -> (level, description); `{}` takes the detail of the case.
ERROR_CODES = {
    "ERR-EX1001": ("Error", "File size is larger than 50MB"),
    "ERR-EX1002": ("Error", "Page count is more than 200"),
    "WRN-EX1004": ("Warning", "No table extracted from the given pdf report"),
    "WRN-EX1009": ("Warning", "Cannot find page containing SIT or PST from the given report: {}"),
    "ERR-EX1010": ("Error", "Cannot process merged cell spanning more than 2 rows: {}"),
    "ERR-ID1001": ("Error", "The csv file is invalid"),
    "WRN-ID2001": ("Warning", "The report type is unsupported, maybe split by series"),
    "WRN-ID2002": ("Warning", "Less than 3 columns identified, table is invalid"),
    "ERR-ID1002": ("Error", "P1 rule {} has multi-matches"),
    "WRN-ID2003": ("Warning", "P2 rule {} has multi-matches"),
    "WRN-ID2004": ("Warning", "The schedule of investments table of type C2 is unsupported: {}"),
    "ERR-ID1003": ("Error", "Missing required configs, ['Patterns', 'Method', 'Priority'] are required, "
                            "config is invalid"),
    "ERR-ID1004": ("Error", "Invalid method in rule, config is invalid"),
    "ERR-ID1005": ("Error", "The extractor does not support this csv file that should be identified"),
    "ERR-ID1006": ("Error", "The schedule of investments table of type C1 is invalid, does not align with the "
                            "expected schema."),
    "WRN-TR2001": ("Warning", "Table is null after transformation"),
    "WRN-VA2001": ("Warning", "Table validation failed, 'UnrealizeValue' + 'RealizedValue' = 'Total' NOT Passed"),
}

# Limits named by the codes above.
MAX_FILE_BYTES = 50 * 1024 * 1024
MAX_PAGES = 200


def error_row(code: str) -> list[Column]:
    """code, level and description columns of one fixed code without detail."""
    level, text = ERROR_CODES[code]
    return [F.lit(code).alias("code"), F.lit(level).alias("level"), F.lit(text).alias("description")]


def describe(code: Column, detail: Column) -> list[Column]:
    """level and description for a column of codes."""
    level = text = None
    for key, (lv, pattern) in ERROR_CODES.items():
        said = F.replace(F.lit(pattern), F.lit("{}"), F.coalesce(detail, F.lit("")))
        level = F.when(code == key, lv) if level is None else level.when(code == key, lv)
        text = F.when(code == key, said) if text is None else text.when(code == key, said)
    return [level.alias("level"), text.alias("description")]


def message(code: Column, level: Column, description: Column) -> Column:
    """`[code] level: description`."""
    return F.format_string("[%s] %s: %s", code, level, description)


def without_tables(manifests: DataFrame) -> DataFrame:
    """Warnings for element manifests (`name`, `elements`) that name no table file."""
    empty = ~F.coalesce(F.exists("elements", lambda e: e["filePaths"].isNotNull()), F.lit(False))
    return manifests.where(empty).select("name", *error_row("WRN-EX1004"))


def without_pages(registry: DataFrame) -> DataFrame:
    """Warnings for documents of the page registry in which no table page was found."""
    missing = registry.where(~F.col("is_processed")).select("report_path", F.lit("WRN-EX1009").alias("code"))
    return missing.select("report_path", "code", *describe(F.col("code"), F.col("report_path")))


def admit_reports(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split reports (`report_path`, `file_bytes`, `page_count`) into admitted ones and error rows."""
    code = F.when(F.col("file_bytes") > MAX_FILE_BYTES, "ERR-EX1001").when(F.col("page_count") > MAX_PAGES, "ERR-EX1002")
    coded = reports.withColumn("code", code)
    rejected = coded.where("code IS NOT NULL")
    return (coded.where("code IS NULL").drop("code"),
            rejected.select("report_path", "code", *describe(F.col("code"), F.col("report_path"))))
