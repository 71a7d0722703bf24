"""Joins in time, merged states and cubes over events, orders and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.operators import rollup
from tablefolio.operators.temporal import as_of, in_intervals
from tablefolio.plans.catalogue import Catalogue, table
from tablefolio.session import written

QUERIES = Catalogue()
MICROS = 1_000_000
START = 1_704_067_200  # the first second of the events

# Orders moved into the month of the events: the same arithmetic in both engines.
PLACED = f"({START} + (o_orderkey * 61) % 2592000)"


def _moved_orders(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", (F.col("o_custkey") % 150).alias("user_id"),
                         (F.expr(PLACED) * MICROS).alias("placed"))


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("moment", F.unix_micros(F.col("ts").cast("timestamp")))


@QUERIES.add(f"""WITH o AS (SELECT o_orderkey, o_custkey % 150 AS user_id, {PLACED} * {MICROS} AS placed FROM orders),
e AS (SELECT user_id, epoch_us(ts) AS moment, event_id, event_type FROM events WHERE user_id % 7 <> 3)
SELECT o_orderkey, CAST(event_id AS VARCHAR) AS event_id, event_type, CAST((placed - moment) AS VARCHAR) AS micros_ago
FROM o ASOF LEFT JOIN e ON o.user_id = e.user_id AND o.placed >= e.moment""")
def order_as_of_event(spark, sf):
    """Each order with the latest earlier event of its customer; some customers have no events."""
    events = _events(spark, sf).where("user_id % 7 <> 3").select("user_id", "moment", "event_id", "event_type")
    found = as_of(_moved_orders(spark, sf), events, ("user_id",), "placed", "moment", ("moment", "event_id", "event_type"))
    return found.select("o_orderkey", F.col("event_id").cast("string").alias("event_id"), "event_type",
                        (F.col("placed") - F.col("moment")).cast("string").alias("micros_ago"))


# Orders are open for some minutes, every 1000th for a day, every 500th not at all.
OPEN = "CASE WHEN o_orderkey % 1000 = 0 THEN 86400 WHEN o_orderkey % 500 = 1 THEN -1 ELSE o_orderkey % 20 * 60 END"


@QUERIES.add(f"""WITH o AS (SELECT o_orderkey, {PLACED} * {MICROS} AS placed, ({PLACED} + {OPEN}) * {MICROS} AS closed FROM orders),
e AS (SELECT event_id, epoch_us(ts) AS moment, user_id FROM events)
SELECT o_orderkey, count(*) AS events, min(event_id) AS first_event, max(event_id) AS last_event, CAST(sum(user_id) AS BIGINT) AS users
FROM o JOIN e ON moment >= placed AND moment <= closed GROUP BY o_orderkey""")
def events_in_orders(spark, sf):
    """The events that lie between the opening and the closing of each order."""
    orders = _moved_orders(spark, sf).withColumn("closed", (F.expr(PLACED) + F.expr(OPEN)) * MICROS).drop("user_id")
    met = in_intervals(_events(spark, sf).select("event_id", "moment", "user_id"), orders, "moment", "placed", "closed", totals={
        "events": ("count", F.lit(1)), "first_event": ("min", F.col("event_id")), "last_event": ("max", F.col("event_id")),
        "users": ("sum", F.col("user_id"))})
    return met.groupBy("o_orderkey").agg(F.sum("events").alias("events"), F.min("first_event").alias("first_event"),
                                         F.max("last_event").alias("last_event"), F.sum("users").alias("users"))


@QUERIES.add("""WITH c AS (SELECT lang, source, CAST(grouping(lang) * 2 + grouping(source) AS INT) AS level, count(*) AS rows,
  CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY CUBE (lang, source))
SELECT coalesce(lang, '*') AS lang, coalesce(source, '*') AS source, level, rows, chars,
  round(100.0::DOUBLE * rows / sum(rows) OVER (PARTITION BY level), 6) AS share FROM c""")
def inventory_cube(spark, sf):
    """Documents by language, source, both and neither, with shares per level."""
    cube = rollup.share_cube(table(spark, sf, "documents"), ("lang", "source"), {"chars": F.col("n_chars")})
    return cube.select(F.coalesce("lang", F.lit("*")).alias("lang"), F.coalesce("source", F.lit("*")).alias("source"),
                       F.col("level").cast("int").alias("level"), "rows", "chars", "share")


@QUERIES.add("""SELECT CAST(isoyear(ts) AS INT) AS year, CAST(week(ts) AS INT) AS week, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_day,
  count(DISTINCT user_id) AS users FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2""")
def weekly_users_from_days(spark, sf):
    """Weekly users from stored states of days; every tenth event comes late and is merged into the state."""
    events = _events(spark, sf)
    late = F.col("event_id") % 10 == 3
    state = written(rollup.day_states(events.where(~late), "user_id", "ts"), "day-states")
    merged = rollup.merged_days(state, rollup.day_states(events.where(late), "user_id", "ts"))
    return rollup.weekly_users(merged).withColumn("last_day", F.col("last_day").cast("string"))


@QUERIES.add("""SELECT user_id, CAST(isoyear(ts) AS INT) AS year, CAST(week(ts) AS INT) AS week, CAST(count(DISTINCT CAST(ts AS DATE)) AS INT) AS num_days
FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""")
def active_days_merged(spark, sf):
    """Active days of each user and week: two states, of early and of late events, united bit by bit."""
    events = _events(spark, sf)
    late = F.col("event_id") % 10 == 3
    both = rollup.active_days(events.where(~late), "user_id", "ts").unionByName(rollup.active_days(events.where(late), "user_id", "ts"))
    return both.groupBy("user_id", "year", "week").agg(F.bit_count(F.bit_or("days")).cast("int").alias("num_days"))
