"""Reports of several tables each, from numbered pages to facts by fund.

Five tables of the layouts in `tables` make a report: two on each of its first two pages and one on the third.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablefolio.operators import pages as PG
from tablefolio.plans.catalogue import Catalogue
from tablefolio.plans.catalogue.tables import SQL_INPUT, table_input
from tablefolio.plans.catalogue.tables_sql import DECIDED, FACTS, LINEAGE, METRIC_ROWS, PROFILE, ROW_STEPS
from tablefolio.plans.report_run import processed_path, run_reports

QUERIES = Catalogue()

SQL_REPORTS = """found AS (SELECT table_id, CAST(substr(table_id, 2) AS BIGINT) AS k FROM hdr),
numbered AS (SELECT *, CAST(floor(k / 5) AS BIGINT) AS doc, CAST(floor((k % 5) / 2) AS INT) + 1 AS page_ori,
  dense_rank() OVER (ORDER BY floor(k / 5), floor((k % 5) / 2)) AS page_new FROM found),
reg AS (SELECT table_id, 'Fund ' || (doc % 7) AS fund_name, 'r' || doc || '.pdf' AS report_name,
  'Fund ' || (doc % 7) || '/' || CASE WHEN page_new < 10 THEN '0' ELSE '' END || page_new || '_r' || doc || '.pdf_'
  || CASE WHEN page_ori % 2 = 1 THEN 'SIT' ELSE 'PST' END || '_' || page_ori
  || CASE WHEN row_number() OVER (PARTITION BY page_new ORDER BY k) = 2 THEN '(1)' ELSE '' END || '.csv' AS csv_path FROM numbered)"""


def _reports(spark, sf):
    headers, rows = table_input(spark, sf)
    number = F.substring("table_id", 2, 20).cast("bigint")
    found = headers.select("table_id", number.alias("table_ord"), F.floor(number / 5).alias("doc_ord"),
                           F.floor((number % 5) / 2).cast("int").alias("page"))
    path = F.concat(F.lit("/gp/Fund "), (F.col("doc_ord") % 7).cast("string"), F.lit("/r"), F.col("doc_ord").cast("string"), F.lit(".pdf"))
    docs = found.select("doc_ord").distinct().select("doc_ord", path.alias("report_path"), F.lit(3).alias("page_count"))
    kept = found.select("doc_ord", "page", F.when(F.col("page") % 2 == 0, "SIT").otherwise("PST").alias("table_type")).distinct()
    target = processed_path("/out", F.array(F.lit("/gp")))
    pages = PG.number_pages(docs, kept).withColumn("processed_report_path", target)
    places = pages.select("doc_ord", (F.col("page_ori") - 1).alias("page"), "page_new", "processed_report_path")
    tables = found.join(places, ["doc_ord", "page"]).select("table_id", "processed_report_path", "page_new", "table_ord")
    return run_reports(pages.drop("doc_ord"), tables, headers, rows)


_PATH_TO_FACTS = f"{SQL_INPUT}, {PROFILE}, {DECIDED}, {LINEAGE}, {METRIC_ROWS}, {ROW_STEPS}, " + FACTS.replace(
    "AS n1 FROM step8", "AS n1, unrealized_value + realized_value AS total_exp FROM step8")


@QUERIES.add(f"""WITH {_PATH_TO_FACTS}, {SQL_REPORTS}
SELECT fund_name, report_name, csv_path, row_idx, company_name, round(total, 6) AS total, round(total_exp, 6) AS total_exp,
  CASE WHEN list_contains(string_split(filled, ','), 'total') THEN NULL ELSE coalesce(CAST(total_exp = total AS VARCHAR), 'unknown') END AS total_check
FROM facts JOIN reg USING (table_id)""")
def facts_by_fund(spark, sf):
    check = F.when(~F.array_contains("filled_metrics", "total"), F.coalesce(F.col("total_matches").cast("string"), F.lit("unknown")))
    return _reports(spark, sf).facts.select(
        "fund_name", "report_name", "csv_path", "row_idx", "company_name", F.round("total", 6).alias("total"),
        F.round("total_exp", 6).alias("total_exp"), check.alias("total_check"))


@QUERIES.add(f"""WITH {_PATH_TO_FACTS}, {SQL_REPORTS},
coded AS (SELECT table_id, CASE WHEN code IS NULL AND table_id NOT IN (SELECT table_id FROM facts) THEN 'WRN-ID2002' ELSE code END AS code FROM verdict)
SELECT fund_name, code, count(*) AS n_tables, min(csv_path) AS first_file FROM coded JOIN reg USING (table_id) WHERE code IS NOT NULL GROUP BY ALL""")
def errors_by_fund(spark, sf):
    return _reports(spark, sf).errors.groupBy("fund_name", "code").agg(
        F.count("*").alias("n_tables"), F.min("csv_path").alias("first_file"))
