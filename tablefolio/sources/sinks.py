"""Outputs and incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio import schemas


def write_tables(rows: DataFrame, path: str) -> None:
    """Table rows below one folder per fund; rows are spread by table, so a large fund gives many files."""
    rows.repartition("fund_name", "table_id").write.mode("append").partitionBy("fund_name").parquet(path)


def csv_line(values: Column) -> Column:
    """Cells as one CSV record: every cell quoted, null as an empty cell."""
    quoted = F.transform(values, lambda v: F.coalesce(
        F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")))
    return F.array_join(quoted, ",")


def write_table_files(headers: DataFrame, rows: DataFrame, path: str) -> None:
    """One CSV file per table below a folder per fund, as `read_tables(..., has_index_col=False)` reads it back.

    headers: fund_name, table_id, header. rows: fund_name, table_id, row_idx, values.
    """
    head = headers.select("fund_name", "table_id", F.lit(-1).alias("row_idx"), csv_line(F.col("header")).alias("value"))
    body = rows.select("fund_name", "table_id", "row_idx", csv_line(F.col("values")).alias("value"))
    lines = head.unionByName(body).repartition("fund_name", "table_id").sortWithinPartitions("fund_name", "table_id", "row_idx")
    lines.select("fund_name", "table_id", "value").write.mode("append").partitionBy("fund_name", "table_id").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_sheet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Replace a managed table and its schema."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def append_registry(registry: DataFrame, more: DataFrame) -> DataFrame:
    """Add registry rows; a column the registry does not know is an error."""
    known = [c.split()[0] for c in schemas.PAGE_REGISTRY.split(", ")]
    unknown = [c for c in more.columns if c not in known]
    if unknown:
        raise ValueError(f"unknown registry columns {unknown}")
    return registry.select(*known).unionByName(more, allowMissingColumns=True)


def not_yet_done(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs without output from an earlier run."""
    return inputs.join(done.select(key), key, "left_anti")


def read_done(spark: SparkSession, path: str, key: str) -> DataFrame:
    return spark.read.parquet(path).select(key).distinct()
