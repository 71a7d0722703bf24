"""Small helpers the corpus operators share."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefolio.session import shared_folder

NO_ID = -(1 << 63)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def at(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder URI; works in tasks and on the driver."""
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


@contextmanager
def committed(folder: str, name: str):
    """Write `folder/name` under a temporary name of this task attempt and rename it when it is complete.

    A lost or repeated attempt leaves only files with temporary names, which no manifest lists.
    """
    files, base = at(folder)
    files.create_dir(base, recursive=True)
    context = TaskContext.get()
    attempt = context.taskAttemptId() if context else 0
    temporary = f"{base}/_temporary-{attempt}-{os.getpid()}-{name}"
    with files.open_output_stream(temporary, compression=None) as out:
        yield out
    files.move(temporary, f"{base}/{name}")


def text_order(id_col: str, text_col: str) -> Column:
    """A struct that orders documents by id (none first), and apart from equal rows has no ties."""
    return F.struct(F.coalesce(F.col(id_col), F.lit(NO_ID)).alias("k"), F.col(id_col).isNull().alias("none"),
                    F.xxhash64(text_col).alias("h"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of `df` has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in (name + "_" * k for k in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def count_at_most(df: DataFrame, most: int) -> int | None:
    """The number of rows, or None if there are more than `most`; reads no more than it must."""
    n = df.limit(most + 1).count()
    return n if n <= most else None


def bound_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Limit Arrow batches to `most` bytes, so that rows of any size reach Python a few at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name)).rstrip("b")) > most:
        spark.conf.set(name, most)
