"""Pages and tables to facts by fund, and back from the files written."""

import pytest
from pyspark.sql import functions as F

from tablefolio.operators.pages import number_pages
from tablefolio.plans.portfolio import build_portfolio
from tablefolio.plans.report_run import processed_path, run_reports, write_run
from tablefolio.sources.csv_tables import read_tables

HEADER = ["Company", "Total Cost", "Unrealized", "Realized Proceeds", "Total Value"]


def lines(total):
    return [[f"Firm {k}", "10", "5", "6", total] for k in range(6)]


@pytest.fixture(scope="module")
def run(spark):
    docs = spark.createDataFrame([(1, "/gp/Fund A/one.pdf", 4), (2, "/gp/Fund B/two.pdf", 2), (3, "/gp/Fund B/none.pdf", 1)],
                                 "doc_ord long, report_path string, page_count int")
    kept = spark.createDataFrame([(1, 3, "SIT"), (2, 0, "PST")], "doc_ord long, page int, table_type string")
    target = processed_path("/out/", F.array(F.lit("/gp/Fund A/one.pdf"), F.lit("/gp/Fund B/two.pdf")))
    pages = number_pages(docs, kept).withColumn("processed_report_path", target)
    path = pages.first().processed_report_path
    assert path.startswith("/out/report_") and path.endswith(".pdf")
    tables = spark.createDataFrame(
        [("a", path, 1, 1), ("b", path, 1, 2), ("c", path, 2, 3), ("lost", path, 9, 4), ("unread", path, 2, 5)],
        "table_id string, processed_report_path string, page_new long, table_ord long")
    headers = spark.createDataFrame([(t, HEADER) for t in ("a", "b", "c", "lost")], "table_id string, header array<string>")
    totals = {"a": "11", "b": "12", "c": None, "lost": "11"}
    rows = spark.createDataFrame([(t, i, v) for t, x in totals.items() for i, v in enumerate(lines(x))],
                                 "table_id string, row_idx int, values array<string>")
    return run_reports(pages, tables, headers, rows), headers, rows


def test_facts_know_their_fund_and_file(run):
    got = {(r.fund_name, r.report_name, r.csv_path, r.total_matches) for r in run[0].facts.collect()}
    assert got == {("Fund A", "one.pdf", "Fund A/01_one.pdf_SIT_4.csv", True), ("Fund A", "one.pdf", "Fund A/01_one.pdf_SIT_4(1).csv", False),
                   ("Fund B", "two.pdf", "Fund B/02_two.pdf_PST_1.csv", None), (None, None, None, True)}
    assert run[0].facts.count() == 24
    filled = run[0].lineage.where("rule = 'VA'").collect()
    assert {(r.csv_path, r.target) for r in filled} >= {("Fund B/02_two.pdf_PST_1.csv", "total")}


def test_unread_table_is_an_error_of_its_file(run):
    assert [(r.csv_path, r.code) for r in run[0].errors.collect()] == [("Fund B/02_two.pdf_PST_1(1).csv", "ERR-ID1001")]


def test_written_files_give_the_same_facts(spark, run, tmp_path):
    done, headers, rows = run
    write_run(done, headers, rows, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/facts")
    key = ["fund_name", "csv_path", "row_idx", "company_name", "total", "total_exp"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, done.facts.select(key).collect()))
    assert {p.name for p in (tmp_path / "tables").iterdir() if p.is_dir()} == {"fund_name=Fund A", "fund_name=Fund B"}
    again = build_portfolio(*read_tables(spark, f"{tmp_path}/tables/*/*", has_index_col=False)).facts
    numbers = ["row_idx", "company_name", "total_cost", "unrealized_value", "realized_value", "total"]
    want = done.facts.where("fund_name IS NOT NULL").select(numbers).collect()
    assert sorted(map(str, again.select(numbers).collect())) == sorted(map(str, want))


def test_no_tables(spark, run):
    done, headers, rows = run
    pages = spark.createDataFrame([], "report_path string, report_name string, page_count int, page_ori int, page_new long, "
                                      "table_type string, is_processed boolean, processed_report_path string")
    tables = spark.createDataFrame([], "table_id string, processed_report_path string, page_new long, table_ord long")
    empty = run_reports(pages, tables, headers.where("false"), rows.where("false"))
    assert empty.facts.count() == empty.errors.count() == empty.lineage.count() == 0
