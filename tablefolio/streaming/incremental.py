"""Incremental extraction: only files that no earlier run has seen are processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablefolio import schemas
from tablefolio.operators.grid import header_and_rows, table_rows
from tablefolio.plans.portfolio import build_portfolio
from tablefolio.session import durable
from tablefolio.sources.csv_tables import from_grid


def process_new_cells(spark: SparkSession, cells_path: str, out_path: str, state_path: str) -> None:
    """Process the layout-cell files that arrived since the last run, then stop.

    The file source keeps the list of finished files in `state_path`. A batch is written under its number with
    overwrite, so a batch that is repeated after a failure replaces its own output. A table must lie in one file.
    """

    def one_batch(cells: DataFrame, number: int) -> None:
        headers, rows = from_grid(*header_and_rows(table_rows(cells)), cut=durable)
        built = build_portfolio(headers, rows)
        for name in ("facts", "lineage", "errors"):
            getattr(built, name).write.mode("overwrite").parquet(f"{out_path}/{name}/batch={number}")

    stream = spark.readStream.schema(schemas.LAYOUT_CELLS).json(cells_path)
    query = (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", state_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
