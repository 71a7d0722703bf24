"""Sheets of cells as rows of named values: a table function for SQL, called once per sheet with its rows in order."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf


def unnamed(name: str | None) -> bool:
    return not name or "Unnamed" in name


@udtf(returnType="sheet string, row_idx int, name string, value string")
class SheetCells:
    """The first row of a sheet is its header; if more than half of its names are missing, the second is, and the first
    goes. Cells without a name, or beyond the header, keep their place as name. Rows are passed on one by one, so a
    sheet of any length takes no more memory than a row."""

    def __init__(self):
        self.header: list[str | None] | None = None
        self.promoted = False
        self.count = 0

    def eval(self, row: Row) -> Iterator[tuple]:
        values = list(row["values"] or [])
        if self.header is None:
            self.header = values
            return
        if not self.promoted and not self.count and sum(map(unnamed, self.header)) > len(self.header) // 2:
            self.header, self.promoted = values, True
            return
        for place, value in enumerate(values):
            name = self.header[place] if place < len(self.header) else None
            yield row["sheet"], self.count, str(place) if unnamed(name) else name, value
        self.count += 1


def register_sheet_cells(spark: SparkSession) -> None:
    """Make `sheet_cells(TABLE(...) PARTITION BY sheet ORDER BY ...)` known to SQL; columns `sheet` and `values`."""
    spark.udtf.register("sheet_cells", SheetCells)
