"""Recognised layout cells -> rectangular table rows, headers and a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablefolio.operators.ordered import settled


def _row_texts(cells: DataFrame) -> DataFrame:
    """The texts of a grid row as one array of (col_idx, value): table_id, row_idx, texts. The cells move once, by row."""
    spanning = (F.col("row_index") == 0) & F.col("column_span").isNotNull()
    text = F.replace("content", F.lit("\n"), F.lit(" "))
    placed = cells.select(
        "table_id", "cell_ord",
        F.when(spanning, F.lit(1)).otherwise(F.col("row_index")).alias("row_idx"),
        F.explode(F.when(spanning, F.sequence(F.col("column_index"), F.col("column_index") + F.col("column_span") - 1))
                  .otherwise(F.array("column_index"))).alias("col_idx"),
        F.when(spanning, F.concat(text, F.lit(" "))).otherwise(text).alias("part"),
        F.when(spanning, 0).otherwise(1).alias("turn"),
    )
    rows = settled(placed.groupBy("table_id", "row_idx").agg(
        F.array_sort(F.collect_list(F.struct("col_idx", "turn", "cell_ord", "part"))).alias("parts")))

    def joined(col: Column) -> Column:
        own = F.filter("parts", lambda p: p["col_idx"].eqNullSafe(col))
        return F.struct(col.alias("col_idx"), F.array_join(F.transform(own, lambda p: p["part"]), "").alias("value"))

    columns = F.array_distinct(F.transform("parts", lambda p: p["col_idx"]))
    return rows.select("table_id", "row_idx", F.transform(columns, joined).alias("texts"))


def cell_texts(cells: DataFrame) -> DataFrame:
    """One text per grid position: table_id, row_idx, col_idx, value.

    A first-row cell with a span writes its text and a blank into row 1 of every column it spans; other cells add
    their text at their own place, in cell order.
    """
    return _row_texts(cells).select("table_id", "row_idx", F.inline("texts"))


def table_rows(cells: DataFrame) -> DataFrame:
    """Full-width rows `values`; places without a cell are '', and rows without any cell are absent.

    Rows are at most as wide as the recognised table, so one row is a small array.
    """
    width = cells.groupBy("table_id").agg(F.max("column_count").alias("width"))
    rows = _row_texts(cells).select("table_id", "row_idx", F.map_from_entries("texts").alias("by_col"))
    columns = F.sequence(F.lit(0), F.col("width") - 1)
    values = F.transform(columns, lambda c: F.coalesce(F.try_element_at("by_col", c), F.lit("")))
    return settled(rows.join(width, "table_id").select("table_id", "row_idx", values.alias("values")))


def header_and_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row 0 becomes the header; all-empty rows and tables left without rows go away."""
    filled = F.exists("values", lambda v: v != "")
    body = rows.where((F.col("row_idx") > 0) & filled)
    heads = settled(rows.where("row_idx = 0").select("table_id", F.col("values").alias("header")))
    return heads.join(body.select("table_id").distinct(), "table_id", "left_semi"), body


def fund_name(path: Column) -> Column:
    """Name of the folder that holds the report."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def registry_for_tables(tables: DataFrame, pages: DataFrame) -> DataFrame:
    """Report metadata and output path of each table.

    tables: table_id, processed_report_path, page_new, table_ord. pages: the page registry. Tables that share a
    page are told apart by `(1)`, `(2)`, …
    """
    first = pages.groupBy("processed_report_path", "page_new").agg(
        F.min(F.struct("report_path", "report_name", "table_type", "page_ori")).alias("m"))
    joined = tables.join(first, ["processed_report_path", "page_new"]).select("*", "m.*").drop("m")
    place = F.row_number().over(
        Window.partitionBy("processed_report_path", "page_new").orderBy("table_ord")) - 1
    number = F.when(F.length(F.col("page_new").cast("string")) < 2, F.lpad(F.col("page_new").cast("string"), 2, "0")
                    ).otherwise(F.col("page_new").cast("string"))
    named = joined.withColumns({"place": place, "fund_name": fund_name(F.col("report_path"))})
    mark = F.when(F.col("place") > 0, F.concat(F.lit("("), F.col("place").cast("string"), F.lit(")"))).otherwise("")
    name = F.concat(number, F.lit("_"), "report_name", F.lit("_"), "table_type", F.lit("_"),
                    F.col("page_ori").cast("string"), mark, F.lit(".csv"))
    return named.select("table_id", "report_path", "report_name", "table_type", "page_ori", "fund_name",
                        F.concat("fund_name", F.lit("/"), name).alias("csv_path"))


def file_id(name: Column) -> Column:
    """First whole number in a file name."""
    return F.nullif(F.regexp_extract(name, r"\d+", 0), F.lit("")).cast("int")
