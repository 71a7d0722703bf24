"""The whole path: CSV files to facts, and large tables in segments."""

import pytest
from pyspark.sql import functions as F

from tablefolio.operators.analytics import metric_sums
from tablefolio.operators.headers import table_profiles
from tablefolio.operators.ordered import RowOrder
from tablefolio.plans import portfolio
from tablefolio.plans.catalogue import tables
from tablefolio.plans.portfolio import build_portfolio, decide_tables
from tablefolio.rules import DEFAULT_RULES, RuleFileError, read_rules
from tablefolio.session import durable, shared_folder
from tablefolio.sources import records
from tablefolio.sources.csv_tables import fields, from_grid, read_tables, table_files, unreadable

SF = "/root/testdata/sf0.001"

HOLDINGS = '''Company  ,Notes  ,Invested  ,Valuation  ,Realized  ,Total*  ,Investment Multiple  ,Current Ownership  
Unrealized  
"North, Inc.  ","maker of
""small"" things","$1,000  ","$2,000  ",$0  ,"$2,000  ",2.0  ,10.5%  

South (dba Pole)  ,b,"2,000  ","1,500  ",500  ,"2,000  ",1.0  ,(2.5)%  
East  ,c,300  ,-,30  ,330  ,,
,Sub Total  ,"3,300  ","3,500  ",530  ,"4,330  ",1.2  ,
,  Total  ,"$3,300  ","$3,500  ",$530  ,"$4,330  ",1.2  ,
'''
CLASHING = "Name,Proceeds one,Proceeds two,Cost\n" + "\n".join(f"c{i},1,2,3" for i in range(5)) + "\n"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "fund a+b 1.csv").write_text("﻿" + HOLDINGS, encoding="utf-8")
    (folder / "clash.csv").write_text(CLASHING)
    (folder / "short.csv").write_text("a,b,c\n1,2,3\n")
    (folder / "empty.csv").write_text("")
    (folder / "open.csv").write_text("Company,Cost,Fair Value\n" + "\n".join(f'c{i},1,{chr(34) * (i == 3)}2' for i in range(20)) + "\n")
    return str(folder)


def named(df):
    return {(r.table_id.rsplit("/", 1)[1]): r for r in df.collect()}


def test_csv_to_facts(spark, files):
    headers, rows = read_tables(spark, files, has_index_col=False, cut=durable)
    expected = table_files(spark, files)
    assert sorted((r.table_id.rsplit("/")[-1], r.code) for r in unreadable(expected, headers).collect()) == [
        ("empty.csv", "ERR-ID1001"), ("open.csv", "ERR-ID1001")]
    built = build_portfolio(headers, rows, expected=expected)
    errors = {n: (r.code, r.description) for n, r in named(built.errors).items()}
    assert errors["clash.csv"] == ("ERR-ID1002", "P1 rule realized_value has multi-matches")
    assert errors["short.csv"][0] == "WRN-ID2002" and errors["open.csv"][0] == errors["empty.csv"][0] == "ERR-ID1001"
    facts = sorted(built.facts.collect(), key=lambda r: r.row_idx)
    assert [(r.company_name, r.total_cost, r.unrealized_value, r.is_total) for r in facts] == [
        ("North, Inc.  ", 1000, 2000, False), ("South (dba Pole)  ", 2000, 1500, False), ("East  ", 300, 300, False),
        (None, 3300, 3500, True)]
    assert [r.ownership for r in facts] == [0.105, -0.025, None, None]
    sums = metric_sums(built.facts, ["total_cost", "total", "realized_value"]).first()
    assert (sums.total_cost, sums.total, sums.realized_value) == (3300, 4330, 530)
    targets = {(r.target, r.src, r.rule) for r in built.lineage.collect() if r.table_id.endswith("1.csv")}
    assert ("total_cost", "Invested", "P2") in targets and ("unrealized_value", None, "VA") in targets


def test_csv_over_many_splits(spark, files):
    whole = [sorted(map(str, d.collect())) for d in read_tables(spark, files, has_index_col=False)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = [sorted(map(str, d.collect())) for d in read_tables(spark, files, has_index_col=False)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert split == whole


def test_ragged_rows(spark, tmp_path):
    (tmp_path / "r.csv").write_text("i,a,b\n0,1\n1,2,3,4\n")
    kept = read_tables(spark, str(tmp_path))
    assert kept[0].first().header == ["a", "b", ""]
    assert sorted(r["values"] for r in kept[1].collect()) == [["1", None, None], ["2", "3", "4"]]
    cut = read_tables(spark, str(tmp_path), keep_surplus=False)
    assert sorted(r["values"] for r in cut[1].collect()) == [["1", None], ["2", "3"]]


def test_large_tables_in_segments(spark):
    headers, rows = tables._input(spark, SF)
    plain, cut = build_portfolio(headers, rows), build_portfolio(headers, rows, segment_rows=9)
    for name in ("facts", "lineage", "errors"):
        a, b = (sorted(map(str, getattr(p, name).collect())) for p in (plain, cut))
        assert a and a == b


def test_profiles_are_counted_without_sorting_cells(spark):
    """All counts are hashed as the cells come; a repeated first row gives the greater text and the counts of both."""
    headers = spark.createDataFrame([("t", ["Firm", "Cost"]), ("u", ["a", "b"]), ("empty", ["a"])], "table_id string, header array<string>")
    rows = spark.createDataFrame(
        [("t", 0, ["b", None]), ("t", 0, ["c", "$5"]), ("t", 1, ["d", "1"]), ("t", 2, ["Series A", "2"]), ("t", 9, [None, "x"]),
         ("u", 0, ["same", "1"]), ("u", 0, ["same", "1"])], "table_id string, row_idx int, values array<string>")
    found = table_profiles(headers, rows)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.table_id: r.cells and [(c.zone, c.col_idx, c.text, c.stats[:6]) for c in r.cells] for r in found.collect()}
    assert got == {
        "t": [(0, 0, "c", [2, 2, 0, 0, 0, 0]), (0, 1, "$5", [2, 1, 0, 1, 5, 0]), (1, 0, "d", [1, 1, 0, 0, 0, 0]),
              (1, 1, "1", [1, 1, 1, 1, 1, 0]), (2, 0, None, [2, 1, 0, 0, 0, 1]), (2, 1, None, [2, 2, 1, 1, 2, 0])],
        "u": [(0, 0, "same", [2, 2, 0, 0, 0, 0]), (0, 1, "1", [2, 2, 2, 2, 2, 0])], "empty": None}


def test_rows_sort_in_partitions_that_do_not_grow(spark, monkeypatch):
    """The number of partitions of the row steps follows the number of rows; facts, lineage and errors stay the same."""
    headers, rows = tables.table_input(spark, SF)
    assert portfolio.row_partitions(spark, 0) is None and portfolio.row_partitions(spark, 360 * 150_000) == 412
    whole = build_portfolio(headers, rows)
    monkeypatch.setattr(portfolio.row_partitions, "__defaults__", (20,))
    asked, plain = [], portfolio.metric_rows
    monkeypatch.setattr(portfolio, "metric_rows", lambda *a: asked.append(a[-1]) or plain(*a))
    dealt = build_portfolio(headers, rows)
    assert asked[0] == -(-rows.count() // 20)
    for name in ("facts", "lineage", "errors"):
        a, b = (sorted(map(str, getattr(p, name).collect())) for p in (whole, dealt))
        assert a and a == b


def test_number_texts_are_parsed_once_before_the_rows_are_sorted_again(spark):
    """No filter on the parsed numbers may parse them a second time."""
    headers, rows = tables.table_input(spark, SF)
    texts = portfolio.metric_rows(rows, portfolio.durable(portfolio.decide_tables(headers, rows)))
    done = portfolio.normalise(texts, RowOrder(("table_id", "part"), "row_idx", None))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")]
    assert filters and max(line.count("regexp_extract") for line in filters) <= 1  # the ownership, needed as a text until then


def test_heavy_input_in_small_partitions(spark, tmp_path, monkeypatch):
    """A file of one row group is dealt to partitions that do not grow with it, by an expression too."""
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(records, "SPREAD_BYTES", 100)
    df = spark.read.parquet(str(tmp_path / "t"))
    dealt = records.spread(df, F.expr("floor(id / 40)"))
    assert dealt.rdd.getNumPartitions() > 8 * spark.sparkContext.defaultParallelism
    homes = dealt.select(F.expr("floor(id / 40)").alias("t"), F.spark_partition_id().alias("p")).distinct()
    assert homes.count() == 25 and dealt.count() == 1000


def test_rule_file(spark, tmp_path):
    good = tmp_path / "r.json"
    good.write_text('{"company_name": {"ColumnIndex": 0}, "total": {"ColumnNamePattern": '
                    '[{"Patterns": ["Sum"], "Method": "Match", "Priority": 1}]}, "shares": {"ColumnNamePattern": '
                    '[{"Patterns": ["Units"], "Method": "Contain", "Priority": 2}]}}')
    rules = read_rules(str(good))
    assert rules.names() == ["company_name", "total", "shares"]
    headers = spark.createDataFrame([("t", ["Firm", "Sum", "Units held"])], "table_id string, header array<string>")
    rows = spark.createDataFrame([("t", i, ["a", "1", "2"]) for i in range(4)],
                                 "table_id string, row_idx int, values array<string>")
    decided = decide_tables(headers, rows, rules).first()
    assert decided.code is None and [(p.metric, p.src, p.rule) for p in decided.picks] == [
        ("company_name", "Firm", "P1"), ("total", "Sum", "P1"), ("shares", "Units held", "P2")]
    for bad in ('{"a": {"ColumnNamePattern": [{"Patterns": ["x"], "Priority": 1}]}}',
                '{"a": {"ColumnNamePattern": [{"Patterns": ["x"], "Method": "Like", "Priority": 1}]}}'):
        good.write_text(bad)
        with pytest.raises(RuleFileError):
            read_rules(str(good))
    assert len(DEFAULT_RULES.metrics) == 11


def test_long_quoted_cells(spark):
    """A cell of any length and with many doubled quotes is one field."""
    long = "a" * 100_000 + '"' * 5_000
    quoted = '"' + long.replace('"', '""') + '"'
    df = spark.createDataFrame([(f"x,{quoted},,{quoted},y",)], "r string")
    assert df.select(fields(F.col("r"))).first()[0] == ["x", long, "", long, "y"]


def test_two_row_header_from_a_grid(spark):
    """The header row below the first one is found although empty rows lie between."""
    headers = spark.createDataFrame([("t", ["Company", "Unrealized", "", "Realized"])], "table_id string, header array<string>")
    body = [(1, ["", "Cost", "Fair Value", "Proceeds"]), *[(3 + 2 * i, [f"Firm {i}", "1", "2", "3"]) for i in range(5)]]
    rows = spark.createDataFrame([("t", i, v) for i, v in body], "table_id string, row_idx int, values array<string>")
    facts = sorted(build_portfolio(*from_grid(headers, rows)).facts.collect(), key=lambda r: r.row_idx)
    assert [(r.row_idx, r.total_cost, r.unrealized_value, r.realized_value) for r in facts] == [(i, 1, 2, 3) for i in range(5)]


def test_table_left_without_rows(spark):
    headers = spark.createDataFrame([("t", ["Company", "Cost", "Fair Value", "Total"])], "table_id string, header array<string>")
    rows = spark.createDataFrame([("t", i, [f"Firm {i}", "n/m", "tbd", "see"]) for i in range(6)],
                                 "table_id string, row_idx int, values array<string>")
    built = build_portfolio(headers, rows)
    assert built.facts.count() == 0 and built.lineage.count() == 0
    assert [(r.table_id, r.code) for r in built.errors.collect()] == [("t", "WRN-ID2002")]


def test_a_shared_folder_is_needed_outside_local_mode(spark, monkeypatch):
    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "spark://host:7077"
            applicationId = "app"

    if not spark.conf.get("spark.checkpoint.dir", ""):
        with pytest.raises(ValueError):
            shared_folder(Elsewhere())
    assert shared_folder(spark)


# Cost, value and ownership in percent of a published portfolio summary; names are invented.
SUMMARY = """42,450,695 42,157,574 78.7
17,290,800 17,290,800 86.5
13,064,157 13,064,157 16.4
11,350,325 11,350,325 19.8
21,133,200 21,133,200 12.1
28,818,000 28,818,000 18.7
14,889,302 14,889,302 0.9
12,295,679 12,295,679 16.8
8,165,099 8,165,099 22.1
24,014,998 24,014,998 8.8
25,936,200 25,936,200 13.4
15,177,480 15,177,480 17.9
38,423,980 38,423,980 14.2
15,849,900 15,849,900 14.6
21,269,753 23,082,781 48.0
136,375,828 132,806,156 84.1
53,097,874 52,899,237 96.1
26,896,785 26,896,785 13.4
19,463,421 18,825,273 72.8
35,500,892 34,867,339 37.2
8,138,911 8,138,911 4.1
25,696,024 25,696,024 -"""


def test_golden_sums(spark, tmp_path):
    """Sums without the two total rows, as published: cost, unrealized, total and the ownership shares."""
    lines = ["Company  ,Business Description  ,Invested  ,Valuation  ,Realized  ,Total*  ,Gain/(Loss)  ,Investment Multiple  ,"
             "Gross IRR  ,Current Ownership  ", "Unrealized  "]
    for i, line in enumerate(SUMMARY.split("\n")):
        cost, value, share = line.split()
        lines.append(f'"Firm {i}, Inc.  ",text,"{cost}  ","{value}  ",0  ,"{value}  "," (1)  ",1.0  ,0.0%  ,{share + "%  " if share != "-" else ""}')
    for label, sign in (("Sub Total", ""), ("Total", "$")):
        lines.append(f',{label}  ,"{sign}615,299,303  ","{sign}611,779,200  ",{sign}0  ,"{sign}611,779,200  ","(3,520,103)  ",1.0  ,0.3%  ,')
    (tmp_path / "summary.csv").write_text("\n".join(lines) + "\n")
    built = build_portfolio(*read_tables(spark, str(tmp_path), has_index_col=False))
    sums = metric_sums(built.facts, ["total_cost", "unrealized_value", "total", "ownership"]).first()
    assert (sums.total_cost, sums.unrealized_value, sums.total) == (615299303, 611779200, 611779200)
    assert round(sums.ownership, 3) == 6.966
