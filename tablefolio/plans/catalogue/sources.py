"""Files written from the given tables and read back through the readers of `sources/`."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablefolio.plans.catalogue import Catalogue, table
from tablefolio.session import shared_folder
from tablefolio.sources.csv_records import read_csv_records

QUERIES = Catalogue()
LONG_CELL = 50_000


@QUERIES.add(f"""SELECT doc_id, 3 AS n_fields, md5(text) AS text_md5, length(text) AS text_length,
  CASE WHEN doc_id % 50 = 0 AND text <> '' THEN length(text) * CAST(ceil({LONG_CELL} / length(text)) AS INT) ELSE 0 END AS long_length
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def csv_records(spark, sf):
    """Documents with their line breaks and quotes as CSV cells, every 50th with a cell of at least 50,000 characters."""
    text = F.coalesce("text", F.lit(""))
    long = F.when((F.col("doc_id") % 50 == 0) & (text != ""), F.repeat(text, F.ceil(F.lit(LONG_CELL) / F.length(text)).cast("int")))
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, sf, "documents").select("doc_id", text.alias("text"), F.coalesce(long, F.lit("")).alias("long")).write.csv(
        folder, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    f = F.col("fields")
    return read_csv_records(spark, folder).select(
        f[0].cast("long").alias("doc_id"), F.size(f).alias("n_fields"), F.md5(f[1]).alias("text_md5"),
        F.length(f[1]).alias("text_length"), F.length(f[2]).alias("long_length"))
