"""Row operators on small literal tables, with plain windows and in segments."""

import pytest
from pyspark.sql import functions as F

from tablefolio.functions.numbers import parse_money
from tablefolio.operators import rows as R
from tablefolio.operators.headers import clean_header, drop_marks, header_metric_count
from tablefolio.operators.ordered import RowOrder
from tablefolio.operators.validate import filled_lineage, validate_metrics

ORDERS = [RowOrder(("table_id",), "row_idx", None), RowOrder(("table_id",), "row_idx", 4)]


def frame(spark, columns, rows):
    schema = "table_id string, row_idx int, " + ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([("t", i, *r) for i, r in enumerate(rows)], schema)


def ordered(df, *columns):
    return [tuple(r[c] for c in columns) for r in sorted(df.collect(), key=lambda r: r.row_idx)]


@pytest.mark.parametrize("order", ORDERS)
def test_hidden_security(spark, order):
    df = frame(spark, ["company_name", "total_cost", "unrealized_value"], [
        ("Acme", None, None), ("Series A", "10", "12"), ("Series B", "5", "6"), (None, "15", "18"),
        ("Beta", None, None), ("Common Stock", "3", "4")])
    done = R.hidden_security(df, ["company_name", "total_cost", "unrealized_value"], order)
    assert ordered(done, "company_name", "security_type", "total_cost") == [
        ("Acme", "Series A", "10"), ("Acme", "Series B", "5"), ("", "", "15"), ("Beta", "Common Stock", "3")]


@pytest.mark.parametrize("order", ORDERS)
def test_fill_company(spark, order):
    df = frame(spark, ["company_name", "security_type"], [
        ("Acme", "Series A"), ("", "Series B"), ("Beta", "Common"), ("", "Preferred"), (None, "Notes"), ("Last ", None)])
    assert ordered(R.fill_company(df, order), "company_name") == [
        ("Acme",), ("Acme",), ("Beta",), ("Beta",), ("Beta",), ("Last ",)]


@pytest.mark.parametrize("order", ORDERS)
def test_subtotal(spark, order):
    df = frame(spark, ["company_name", "security_type"], [
        ("Acme", "A"), ("Acme", "B"), ("", ""), ("Betacorp", "C"), ("Betacorp", "D"), ("", ""), ("Total", "")])
    done = R.subtotal_flags(df, order)
    assert ordered(done, "company_name", "is_total") == [
        ("Acme", False), ("Acme", False), ("Acme", True), ("Betacorp", False), ("Betacorp", False), ("", False),
        ("Total", False)]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("names, flagged", [
    (["A", "Sub", "Total"], 2), (["A", "Total", "Note"], 1), (["A", None, "Totals "], 2), (["A", "B", "C"], None),
    (["Total Fund II", "x"], 0), ([None], 0)])
def test_bottom_total(spark, order, names, flagged):
    df = frame(spark, ["company_name"], [(n,) for n in names]).withColumn("is_total", F.lit(False))
    assert [i for i, (t,) in enumerate(ordered(R.bottom_total(df, order), "is_total")) if t] == (
        [] if flagged is None else [flagged])


def test_header_texts(spark):
    df = spark.createDataFrame([("Unrealized",), ("Cost Fair Value",), ("Unrealized Realized",)], "t string")
    assert [r[0] for r in df.select(header_metric_count(F.col("t"))).collect()] == [1, 2, 2]
    text = spark.createDataFrame([("Total*  ", "a:selected:b:unselected:")], "h string, c string")
    assert text.select(clean_header(F.col("h")), drop_marks(F.col("c"))).first() == ("Total", "ab")


def test_validation(spark):
    schema = "k int, total double, realized_value double, unrealized_value double, total_cost double, gross_moic double"
    df = spark.createDataFrame([
        (0, 3.0, 1.0, 2.0, None, None), (1, None, 1.0, 2.0, None, None), (2, 3.0, None, 2.0, None, None),
        (3, 3.0, 1.0, None, None, None), (4, None, None, 2.0, None, None), (5, 4.0, 1.0, 2.0, 2.0, 2.0),
        (6, None, 1.0, 2.0, 2.0, None), (7, 3.0, 1.0, 2.0, 0.0, None), (8, None, None, 1.0, 2.0, 3.0)], schema)
    done = {r.k: r for r in validate_metrics(df).collect()}
    assert [done[i].is_validated for i in range(6)] == [True, None, None, None, None, False]
    assert (done[1].total, done[2].realized_value, done[3].unrealized_value, done[4].total) == (3, 1, 2, None)
    assert (done[6].total, done[6].gross_moic, done[7].gross_moic, done[8].total) == (3, 1.5, None, 6)
    filled = {(r.k, r.target) for r in filled_lineage(validate_metrics(df), "k").collect()}
    assert filled == {(1, "total"), (2, "realized_value"), (3, "unrealized_value"), (6, "total"), (6, "gross_moic"),
                      (7, "gross_moic"), (8, "total")}


def test_one_long_group_of_name_pieces(spark):
    """Every row belongs to one group: its name is built once, not once a row."""
    n = 20_000
    df = spark.range(n).select(F.lit("t").alias("table_id"), F.col("id").cast("int").alias("row_idx"),
                               F.when(F.col("id") == 0, "Acme").otherwise("-").alias("company_name"), F.lit("A").alias("security_type"))
    for order in (RowOrder(("table_id",), "row_idx", None), RowOrder(("table_id",), "row_idx", 4096)):
        names = R.fill_company(df, order).groupBy("company_name").count().collect()
        assert [(r.company_name, r["count"]) for r in names] == [("Acme" + "-" * (n - 2) + " -", n)]


def test_name_groups_need_no_shuffle_where_tables_fit_a_task(spark):
    """Plain windows on rows that are dealt already: no further exchange and no join, the same names as in segments."""
    pieces = ["Ac", "-", None, "m", "", "Bet", "a", "x", "Gamma", "", None, "y"]
    rows = [(t, i, pieces[(i * 7 + t) % len(pieces)], [None, "", "A", "B"][(i * i + t) % 4])
            for t in range(9) for i in range(5 + 3 * t)] + [(None, 0, "nobody", "A")]
    df = spark.createDataFrame(rows, "table_id int, row_idx int, company_name string, security_type string")
    plain, cut = RowOrder(("table_id",), "row_idx", None), RowOrder(("table_id",), "row_idx", 4)
    done = R.fill_company(df.repartition(3, "table_id"), plain)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    a, b = (sorted(map(str, d.select(df.columns).collect())) for d in (done, R.fill_company(df, cut)))
    assert len(a) == len(rows) - 1 and a == b


def test_rows_with_one_index_join_their_names_in_order(spark):
    """Repeated row indexes: pieces by name, and all of the last index stand apart."""
    df = spark.createDataFrame(
        [("t", 0, "Ac", "A"), ("t", 1, "m", "A"), ("t", 1, "e", "A"), ("t", 2, "Beta", None), ("t", 2, "Beta", None)],
        "table_id string, row_idx int, company_name string, security_type string")
    for order in ORDERS:
        names = sorted(r.company_name for r in R.fill_company(df, order).collect())
        assert names == ["Ac em", "Ac em", "Ac em", "Beta", "Beta"]


def test_money_of_odd_texts(spark):
    texts = ["$1,234", "(191)", "()", "(", ")(", "(a)(5)", "3.8x", "xx", "$", "", None, "1x2", "(1,5)x", "-", "($ 7)", "1e3", "(3)(4)"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(parse_money(F.col("t"))).collect()] == [
        1234, -191, None, None, None, None, 3.8, None, None, None, None, 12, -15, None, None, 1000, None]
