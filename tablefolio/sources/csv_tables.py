"""Extracted-table CSV files of any width as headers and rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio.operators.errors import error_row
from tablefolio.operators.headers import unique_names
from tablefolio.operators.ordered import RowOrder, settled
from tablefolio.sources.csv_records import read_csv_records

# Cell texts that common CSV readers take as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'  # possessive: a cell of any length takes no stack


def fields(record: Column) -> Column:
    """Fields of one CSV record; quotes are removed and doubled quotes become one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), F.lit(1))

    def one(f: Column) -> Column:
        inner = F.substring(f, F.lit(2), F.length(f) - 2)
        return F.when(F.startswith(f, F.lit('"')) & F.endswith(f, F.lit('"')) & (F.length(f) > 1),
                      F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(f)

    return F.transform(raw, one)


def fit_width(values: Column, width: Column) -> Column:
    """Exactly `width` values: missing ones null, surplus ones dropped."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.get(values, i))


def missing_to_null(values: Column) -> Column:
    return F.transform(values, lambda v: F.when(~v.isin(*MISSING), v))


def read_tables(spark: SparkSession, path: str, has_index_col: bool = True, keep_surplus: bool = True,
                cut: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(headers, rows) of all CSV files under `path`; `table_id` is the file path.

    `has_index_col` drops the ordinal first column that table extraction writes. Rows wider than the header keep
    their cells under blank names, or lose them with `keep_surplus=False`.
    Pass `cut=durable` to parse the files once when several results are used.
    """
    parsed = read_csv_records(spark, path).select(F.col("file_path").alias("table_id"), "record_idx", F.col("fields").alias("f"))
    if has_index_col:
        parsed = parsed.withColumn("f", F.slice("f", F.lit(2), F.greatest(F.size("f") - 1, F.lit(0))))
    parsed = cut(parsed) if cut else parsed
    widths = parsed.groupBy("table_id").agg(
        F.max(F.size("f") if keep_surplus else F.when(F.col("record_idx") == 0, F.size("f"))).alias("width"))
    wide = parsed.join(widths, "table_id").where("width > 0")
    fitted = wide.withColumn("f", fit_width(F.col("f"), F.col("width")))
    names = unique_names(F.transform("f", lambda v: F.coalesce(v, F.lit(""))))
    headers = fitted.where("record_idx = 0").select("table_id", names.alias("header"))
    rows = fitted.where("record_idx > 0").select(
        "table_id", (F.col("record_idx") - 1).cast("int").alias("row_idx"), missing_to_null(F.col("f")).alias("values"))
    return headers, rows


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """`table_id` of every file under `path`, empty ones included: the listing that Spark makes of it anyway."""
    listed = spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "uri string")
    plain = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    return listed.select(F.regexp_replace(plain, "^file:///", "file:/").alias("table_id"))


def unreadable(expected: DataFrame, headers: DataFrame) -> DataFrame:
    """Error rows of the expected tables (`table_id`) that gave no header: missing or empty files, or a quote that is
    never closed."""
    return expected.select("table_id").join(headers, "table_id", "left_anti").select("table_id", *error_row("ERR-ID1001"))


def from_grid(headers: DataFrame, rows: DataFrame,
              cut: Callable[[DataFrame], DataFrame] = lambda d: d) -> tuple[DataFrame, DataFrame]:
    """Rebuilt grids as they would come back from CSV: missing marks to null, repeated names told apart, and the rows
    that are left numbered from 0 without gaps, as header repair and neighbours need them.

    Pass `cut=durable` to rebuild the grids once when several results are used.
    """
    kept = settled(rows.select("table_id", "row_idx", missing_to_null(F.col("values")).alias("values")))
    dense = RowOrder(("table_id",), "row_idx").dense(kept, "row_idx").select("table_id", "row_idx", "values")
    return cut(settled(headers.select("table_id", unique_names(F.col("header")).alias("header")))), cut(dense)
