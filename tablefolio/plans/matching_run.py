"""One matching run: read the validated companies, match them to the master list, replace the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablefolio.operators.entity import match_companies, table_for_mode
from tablefolio.session import durable
from tablefolio.sources.records import master_companies
from tablefolio.sources.sinks import overwrite_table


def run_matching(spark: SparkSession, mode: str, tables: dict[str, str], master_table: str, schema: str = "default",
                 companies: DataFrame | None = None, scorer: str = "ratio",
                 jdbc: dict[str, str] | None = None) -> DataFrame:
    """Match the companies of the mode's table (`tables`: mode -> name) and overwrite it with the result.

    With `companies` given, as for a CSV check, nothing is written. The result is cut at a checkpoint first, because
    the table that is read is also the one that is replaced.
    """
    table = f"{schema}.{table_for_mode(mode, tables)}"
    source = spark.table(table) if companies is None else companies
    matched = durable(match_companies(source, master_companies(spark, master_table, jdbc), scorer))
    if companies is None:
        overwrite_table(matched, table)
    return matched
