"""Streams, versions and table functions over events, customers and parts."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from tablefolio.functions.sheets import register_sheet_cells
from tablefolio.plans.catalogue import Catalogue, table
from tablefolio.session import shared_folder
from tablefolio.sources.versioned import VersionedTable
from tablefolio.streaming.sessions import close_sessions, session_totals, split_late

QUERIES = Catalogue()
START, WIDTH, MINUTE = 1_704_067_200_000_000, 11 * 86_400_000_000, 60_000_000
GAP, DELAY = 45, 10  # minutes

# Three arrivals of eleven days each; every 97th event comes with the last.
ARRIVALS = f"""a AS (SELECT event_id, user_id, epoch_us(ts) AS moment, CAST(round(value * 100) AS BIGINT) AS cents,
  CASE WHEN event_id % 97 = 0 THEN 2 ELSE least(2, (epoch_us(ts) - {START}) // {WIDTH}) END AS arrival FROM events),
told AS (SELECT a.*, top FROM a LEFT JOIN (SELECT k AS arrival, max(moment) AS top FROM a JOIN (SELECT unnest([1, 2]) AS k) ON arrival < k
  GROUP BY k) USING (arrival)),
kept AS (SELECT *, top IS NOT NULL AND moment < top - {DELAY * MINUTE} AS late FROM told)"""


def _arrive(spark, sf):
    """Folder, schema and arrivals (0, 1, 2) of the events."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    micros = F.unix_micros("ts")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    arrival = F.when(F.col("event_id") % 97 == 0, 2).otherwise(F.least(F.lit(2), F.floor((micros - START) / WIDTH)))
    return folder, events.schema, [events.where(arrival == k) for k in range(3)]


@QUERIES.add(f"""WITH {ARRIVALS} SELECT event_id, user_id, cents FROM kept WHERE late""")
def late_events(spark, sf):
    """Events that come more than ten minutes after a later one, taken out of the stream."""
    folder, schema, arrivals = _arrive(spark, sf)
    for rows in arrivals:
        rows.write.mode("append").parquet(f"{folder}/in")
        split_late(spark, f"{folder}/in", schema, f"{folder}/split", f"{folder}/state", "ts", f"{DELAY} MINUTES")
    return spark.read.schema(schema).parquet(f"{folder}/split/late/*").select("event_id", "user_id", "cents")


@QUERIES.add(f"""WITH {ARRIVALS}, marked AS (SELECT user_id, moment, cents, CASE WHEN moment - lag(moment) OVER w <= {GAP * MINUTE} THEN 0 ELSE 1 END AS new
  FROM kept WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY moment)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY moment ROWS UNBOUNDED PRECEDING) AS number FROM marked)
SELECT user_id, min(moment) AS start_micros, max(moment) + {GAP * MINUTE} AS end_micros, count(*) AS events, CAST(sum(cents) AS BIGINT) AS total
FROM numbered GROUP BY user_id, number""")
def user_sessions(spark, sf):
    """Sessions of each user from a stream in three arrivals, without the late rows."""
    folder, schema, arrivals = _arrive(spark, sf)
    args = (f"{folder}/split/on_time", schema, f"{folder}/sessions", f"{folder}/state-sessions", "user_id", "ts", "cents",
            f"{GAP} minutes", f"{DELAY} minutes")
    for k, rows in enumerate(arrivals):
        rows.write.mode("append").parquet(f"{folder}/in")
        split_late(spark, f"{folder}/in", schema, f"{folder}/split", f"{folder}/state", "ts", f"{DELAY} MINUTES")
        if k == 2:
            close_sessions(spark, f"{folder}/split/on_time", schema, "ts", timedelta(days=1))
        session_totals(spark, *args)
    out = spark.read.schema(f"user_id {schema['user_id'].dataType.simpleString()}, start timestamp, end timestamp, events long, total long"
                            ).parquet(f"{folder}/sessions")
    return out.where("user_id IS NOT NULL").select("user_id", F.unix_micros("start").alias("start_micros"),
                                                   F.unix_micros("end").alias("end_micros"), "events", "total")


@QUERIES.add("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'inserted' ELSE 'updated' END AS change FROM customer
WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 1""")
def changed_customers(spark, sf):
    """What an upsert changed: customers that were not there, others with a new balance, and some that come unchanged."""
    customers = table(spark, sf, "customer")
    versions = VersionedTable(spark, f"{shared_folder(spark)}/customers-{uuid.uuid4().hex}", ("c_custkey",), 16)
    versions.create(customers.where("c_custkey % 5 <> 0"))
    balance = F.when(F.col("c_custkey") % 7 == 1, F.coalesce("c_acctbal", F.lit(0.0)) + 1).otherwise(F.col("c_acctbal"))
    batch = customers.where("c_custkey % 5 = 0 OR c_custkey % 7 IN (1, 2)").withColumn("c_acctbal", balance)
    for _ in range(2):  # the second time nothing is left to do
        versions.upsert(batch, "batch 1")
    return versions.changes(0)


@QUERIES.add("""WITH p AS (SELECT *, p_partkey % 40 AS sheet, row_number() OVER (PARTITION BY p_partkey % 40 ORDER BY p_partkey) - 1 AS k FROM part),
c AS (SELECT sheet, k, unnest(['name', CASE WHEN sheet % 2 = 0 THEN 'type' ELSE '1' END, 'size']) AS name,
  unnest([p_name, p_type, CAST(p_size AS VARCHAR)]) AS value FROM p)
SELECT CAST(sheet AS VARCHAR) AS sheet, CAST(k AS INT) AS row_idx, name, value FROM c""")
def sheet_cells(spark, sf):
    """Parts on sheets: odd ones have their names in the second row, one of them missing, below a row without names."""
    part = table(spark, sf, "part").withColumn("sheet", (F.col("p_partkey") % 40).cast("string"))
    body = part.select("sheet", F.col("p_partkey").alias("place"), F.array("p_name", "p_type", F.col("p_size").cast("string")).alias("values"))
    odd = F.col("sheet").cast("int") % 2 == 1
    sheets = body.select("sheet").distinct()
    blank = sheets.where(odd).select("sheet", F.lit(-2).cast("long").alias("place"), F.array(F.lit("Parts"), F.lit(""), F.lit("Unnamed: 2")).alias("values"))
    names = sheets.select("sheet", F.lit(-1).cast("long").alias("place"), F.array(
        F.lit("name"), F.when(odd, F.lit("")).otherwise(F.lit("type")), F.lit("size")).alias("values"))
    register_sheet_cells(spark)
    body.unionByName(blank).unionByName(names).createOrReplaceTempView("tablefolio_sheets")
    return spark.sql("SELECT * FROM sheet_cells(TABLE(SELECT * FROM tablefolio_sheets) PARTITION BY sheet ORDER BY place)")
