"""Sessions of activity from a stream of files, with the rows that come too late in a table of their own.

Two bounded streams: the first splits each batch into rows in time and late ones, the second turns the rows in time into
sessions with a watermark and a session window. Both stop when all files are done and go on from there the next time.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def split_late(spark: SparkSession, arrivals: str, schema: StructType, out: str, state: str, time: str, delay: str) -> None:
    """Rows of new files to `out/on_time` or, if they lie more than `delay` before the latest row of any earlier batch,
    to `out/late`. Everything is written under the batch's number, so a repeated batch replaces its own output."""

    def one_batch(batch: DataFrame, number: int) -> None:
        limit = None
        if number:
            limit = spark.read.parquet(f"{out}/marks").where(F.col("batch") < number).agg(
                F.max("top") - F.expr(f"INTERVAL {delay}")).first()[0]
        late = F.lit(False) if limit is None else F.coalesce(F.col(time) < F.lit(limit), F.lit(False))
        for name, rows in (("on_time", batch.where(~late)), ("late", batch.where(late)),
                           ("marks", batch.agg(F.max(time).alias("top")))):
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(arrivals)
    stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", state).trigger(
        availableNow=True).start().awaitTermination()


def session_totals(spark: SparkSession, rows: str, schema: StructType, out: str, state: str, key: str, time: str, value: str,
                   gap: str, delay: str) -> None:
    """Append finished sessions of new files below `rows` to `out`: key, start, end (the last row plus `gap`), events,
    total. A session is finished when no row in time can reach it any more."""
    stream = spark.readStream.schema(schema).parquet(f"{rows}/*").withWatermark(time, delay)
    totals = stream.groupBy(key, F.session_window(time, gap).alias("session")).agg(
        F.count("*").alias("events"), F.sum(value).alias("total"))
    totals.select(key, "session.start", "session.end", "events", "total").writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()


def close_sessions(spark: SparkSession, rows: str, schema: StructType, time: str, after: timedelta) -> None:
    """Add a row without key so late that every open session is finished: for the end of a bounded stream."""
    top = spark.read.schema(schema).parquet(f"{rows}/*").agg(F.max(time)).first()[0]
    if top is not None:
        row = spark.range(1).select(*[(F.lit(top + after) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name)
                                      for f in schema.fields])
        row.write.mode("overwrite").parquet(f"{rows}/batch=end")
