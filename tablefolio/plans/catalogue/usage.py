"""Usage analytics over events as an activity log and customers as users."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.operators import analytics as A
from tablefolio.plans.catalogue import Catalogue, table
from tablefolio.operators.errors import without_tables
from tablefolio.sources.records import manifest_elements, typed_activity, user_names

QUERIES = Catalogue()

# The log as text: some users are no numbers, event types stand for pages, every third event is a query.
LOG = """SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'guest' WHEN event_id % 5 = 0 THEN concat(CAST(user_id AS {s}), '.0')
    ELSE CAST(user_id AS {s}) END AS userId, CAST(ts AS {s}) AS createdAt, CAST(ts AS {s}) AS updatedAt,
    event_type AS pageName, CASE WHEN event_id % 3 = 0 THEN 'QUERY_RUN' ELSE 'PAGE_VIEW' END AS actionType, props AS query FROM {t}"""
SQL_LOG = f"""log AS (SELECT event_id, CAST(TRY_CAST(userId AS DOUBLE) AS BIGINT) AS userId, CAST(createdAt AS TIMESTAMP) AS createdAt,
  pageName, actionType, query FROM ({LOG.format(s='VARCHAR', t='events')}) WHERE TRY_CAST(userId AS DOUBLE) IS NOT NULL),
users AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS firstName, c_name AS lastName FROM customer),
act AS (SELECT log.*, firstName || ' ' || lastName AS userName, CAST(createdAt AS DATE) AS date,
  CAST(week(createdAt) AS INT) AS week, CAST(year(createdAt) AS INT) AS year FROM log LEFT JOIN users ON userId = id)"""


def _log(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("tablefolio_events")
    return typed_activity(spark.sql(LOG.format(s="STRING", t="tablefolio_events")))


def _users(spark, sf):
    first = F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment"))
    nested = table(spark, sf, "customer").select(F.array(F.struct(
        F.col("c_custkey").alias("id"), first.alias("firstName"), F.col("c_name").alias("lastName"))).alias("users"))
    return user_names(nested)


def _activity(spark, sf):
    return A.with_user_name(_log(spark, sf), _users(spark, sf))


def _date_text(df):
    return df.withColumn("date", F.col("date").cast("string"))


@QUERIES.add("""SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS "firstName", c_name AS "lastName",
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment || ' ' || c_name END AS "userName" FROM customer""")
def users_from_nested(spark, sf):
    return _users(spark, sf)


@QUERIES.add(f"""WITH {SQL_LOG} SELECT event_id, userId AS "userId", userName AS "userName", pageName AS "pageName",
  actionType AS "actionType", strftime(createdAt, '%Y-%m-%d %H:%M:%S') AS created, CAST(date AS VARCHAR) AS date, week, year FROM act""")
def activity_log(spark, sf):
    return _activity(spark, sf).select(
        "event_id", "userId", "userName", "pageName", "actionType",
        F.date_format("createdAt", "yyyy-MM-dd HH:mm:ss").alias("created"), F.col("date").cast("string").alias("date"),
        "week", "year")


@QUERIES.add(f"""WITH {SQL_LOG} SELECT week, CAST(max(date) AS VARCHAR) AS date, count(DISTINCT userId) AS users FROM act GROUP BY week""")
def weekly_active_users(spark, sf):
    return _date_text(A.weekly_active_users(_activity(spark, sf)))


@QUERIES.add(f"""WITH {SQL_LOG} SELECT CAST(date AS VARCHAR) AS date, count(*) AS queries FROM act WHERE actionType = 'QUERY_RUN' GROUP BY date""")
def queries_per_day(spark, sf):
    return _date_text(A.queries_per_day(_activity(spark, sf)))


@QUERIES.add(f"""WITH {SQL_LOG} SELECT event_id, userId AS "userId", userName AS "userName" FROM act WHERE pageName = 'view'""")
def page_activity(spark, sf):
    return A.on_page(_activity(spark, sf), "view").select("event_id", "userId", "userName")


@QUERIES.add(f"""WITH {SQL_LOG} SELECT week, pageName AS "pageName", count(*) AS n FROM act
WHERE week >= (SELECT max(week) FROM act) - 2 GROUP BY week, pageName""")
def recent_weeks(spark, sf):
    return A.recent_weeks(_activity(spark, sf), 2).groupBy("week", "pageName").agg(F.count("*").alias("n"))


@QUERIES.add(f"""WITH {SQL_LOG}, recent AS (SELECT * FROM act WHERE pageName = 'view' AND userName IS NOT NULL
  AND week >= (SELECT max(week) FROM act WHERE pageName = 'view') - 10)
SELECT userName AS "userName", year, week, count(DISTINCT date) AS num_days, concat(year, '-W', week) AS week_label
FROM recent GROUP BY ALL""")
def user_week_days(spark, sf):
    return A.user_week_days(A.recent_weeks(A.on_page(_activity(spark, sf), "view")))


@QUERIES.add(f"""WITH {SQL_LOG}, recent AS (SELECT * FROM act WHERE pageName = 'view' AND userName IS NOT NULL
  AND week >= (SELECT max(week) FROM act WHERE pageName = 'view') - 10),
days AS (SELECT userName, week, year, count(DISTINCT date) AS d FROM recent GROUP BY ALL)
SELECT userName AS "userName", {', '.join(f'coalesce(max(d) FILTER (week = {w} AND year = 2024), 0) AS "2024-W{w}"' for w in (1, 2, 3, 4, 5))}
FROM days GROUP BY userName""")
def user_week_heatmap(spark, sf):
    days = A.user_week_days(A.recent_weeks(A.on_page(_activity(spark, sf), "view")))
    return A.heatmap(days, ("2024-W1",))  # the other weeks come from the data


@QUERIES.add(f"""WITH {SQL_LOG} SELECT week, count(DISTINCT userId) AS users FROM act
WHERE week < (SELECT max(week) FROM act) GROUP BY week""")
def weekly_users_before_last(spark, sf):
    return A.weekly_users_before_last(_activity(spark, sf))


SQL_TOP = f"""{SQL_LOG}, uses AS (SELECT week, userId, count(*) AS uses FROM act WHERE actionType = 'QUERY_RUN' GROUP BY ALL),
top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week ORDER BY uses DESC, userId) AS INT) AS place FROM uses) WHERE place <= 5)"""


def _queries(spark, sf):
    return _activity(spark, sf).where(F.col("actionType") == A.QUERY_ACTION)


@QUERIES.add(f"""WITH {SQL_TOP} SELECT week, userId AS "userId", uses, place FROM top""")
def top_users(spark, sf):
    return A.top_users(_queries(spark, sf))


@QUERIES.add(f"""WITH {SQL_TOP} SELECT userId AS "userId", count(*) AS weeks_in_top FROM (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY uses DESC, userId) AS p FROM uses) WHERE p <= 60 GROUP BY userId HAVING count(*) > 3""")
def frequent_top_users(spark, sf):
    return A.frequent_top_users(A.top_users(_queries(spark, sf), 60))


@QUERIES.add(f"""WITH {SQL_TOP} SELECT userId AS "userId", count(*) AS uses FROM act WHERE actionType = 'QUERY_RUN'
GROUP BY userId HAVING count(*) < 18""")
def inactive_users(spark, sf):
    return A.inactive_users(_queries(spark, sf), 18)


@QUERIES.add(f"""WITH {SQL_LOG} SELECT week, query, count(*) AS uses FROM act WHERE actionType = 'QUERY_RUN' GROUP BY week, query""")
def weekly_query_counts(spark, sf):
    return A.weekly_query_counts(_queries(spark, sf), "query")


# Manifests: one per document, one element per sentence; every fourth has no file, every seventh no page.
@QUERIES.add("""WITH e AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS i, unnest(p) AS s, len(p) AS n
  FROM (SELECT doc_id, string_split(text, '. ') AS p FROM documents)),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS idx FROM e WHERE i % 4 <> 3)
SELECT concat('doc', doc_id) AS name, CAST(n AS INT) AS page_count, concat('doc', doc_id, '/doc', doc_id, '_', idx, '.csv') AS csv_path,
  CASE WHEN i % 3 = 0 THEN NULL ELSE CAST(len(string_split(s, ' ')) AS VARCHAR) END AS col_num, CAST(length(s) AS INT) AS row_num,
  CAST(i + 1 AS INT) AS page FROM f WHERE i % 7 <> 6""")
def manifest_tables(spark, sf):
    return manifest_elements(_manifests(spark, sf)).withColumn("col_num", F.col("col_num").cast("string"))


@QUERIES.add("""SELECT concat('doc', doc_id) AS name, 'WRN-EX1004' AS code, 'Warning' AS level,
  'No table extracted from the given pdf report' AS description FROM documents
WHERE text IS NULL OR len(string_split(text, '. ')) = 0 OR (doc_id % 10 = 0)""")
def manifests_without_tables(spark, sf):
    """Every tenth manifest names no file."""
    made = _manifests(spark, sf).withColumn("elements", F.when(
        F.substring("name", -1, 1) == "0", F.transform("elements", lambda e: e.withField("filePaths", F.lit(None).cast("array<string>"))))
        .otherwise(F.col("elements")))
    return without_tables(made)


def _manifests(spark, sf):
    parts = F.split("text", r"\. ")

    def element(s, i):
        path = F.concat(F.lit("t"), i.cast("string"))
        return F.struct(
            F.when(i % 4 != 3, F.array(path)).alias("filePaths"), F.when(i % 7 != 6, i + 1).alias("Page"),
            F.struct(F.when(i % 3 != 0, F.size(F.split(s, " "))).alias("NumCol"), F.length(s).alias("NumRow")
                     ).alias("attributes"))

    return table(spark, sf, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"),
        F.struct(F.size(parts).alias("page_count")).alias("extended_metadata"),
        F.transform(parts, element).alias("elements"))
