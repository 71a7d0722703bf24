"""Page chains with small segments, span filters and the carried header on literal pages."""

from pyspark.sql import functions as F

from tablefolio.operators import grid
from tablefolio.operators import pages as PG
from tablefolio.plans.catalogue import pages as catalogue_pages

FEATURES = ("doc_id int, page int, own_type string, long_enough boolean, "
            f"top_spans array<{PG.SPAN}>, tail_spans array<{PG.SPAN}>")


def spans(xs, text="w"):
    return [(text, 9.0, 1.0, 0.0, float(x), 5.0, float(x) + 20, 15.0) for x in xs]


def test_chain(spark):
    near, far = spans(range(0, 60, 10)), spans(range(5, 65, 10))
    rows = [(1, 0, None, True, near, near), (1, 1, "SIT", True, near, near), (1, 2, None, True, near, near),
            (1, 3, None, True, near, far), (1, 4, None, True, near, near), (1, 5, "PST", False, near, near),
            (1, 6, "PST", True, near, near), (1, 7, None, False, near, near), (1, 8, None, True, near, near),
            (2, 0, None, True, near, near), (2, 1, "PST", True, near[:3], near[:3]), (2, 2, None, True, near[:3], near)]
    df = spark.createDataFrame(rows, FEATURES)
    for segment in (None, 3):
        done = PG.chain_pages(df, segment_rows=segment, cut=lambda d: d)
        assert sorted((r.doc_id, r.page, r.table_type, r.is_continuation) for r in done.collect()) == [
            (1, 1, "SIT", False), (1, 2, "PST", True), (1, 3, "PST", True), (1, 6, "PST", False), (2, 1, "PST", False)]


def test_aligned_count_uses_each_edge_once(spark):
    df = spark.createDataFrame([([0.0, 0.5, 10.0], [0.4, 10.9, 30.0]), ([1.0], []), ([0.0, 0.9], [0.8, 1.8])],
                               "a array<double>, b array<double>")
    assert [r[0] for r in df.select(PG.aligned_count(F.col("a"), F.col("b"))).collect()] == [2, 0, 2]


def test_kept_spans_and_carried_header(spark):
    def span(text, x=10.0, y=20.0, size=9.0, direction=1.0, width=30.0):
        return (text, size, direction, y, x, y, x + width, y + 10)

    page = [span("Total Cost"), span("note", x=12.0, y=12.0), span("CONFIDENTIAL"), span("big", size=20.0),
            span("tilted", direction=0.5), span("CURRENT FAIR VALUE"), span("I", x=14.0, width=2.0)]
    after = [span("Firm", y=30.0), span("$1,200", y=100.7)]
    df = spark.createDataFrame([(page, after)], f"prev array<{PG.SPAN}>, top array<{PG.SPAN}>")
    kept = PG.kept_spans(F.col("prev"))
    assert [s.text for s in df.select(kept).first()[0]] == ["Total Cost", "note", "I"]
    header = df.select(PG.carried_header(F.col("top"), kept)).first()[0]
    assert [(s.text, s.x, s.y, s.rotated) for s in header] == [
        ("Total Cost", 10.0, 20 - 30 + 100 - 12, False), ("I", 14.0, 88.0, True)]
    assert df.select(PG.carried_header(F.col("prev"), F.col("top"))).first()[0] == []


def test_spans_are_built_in_doubles(spark, tmp_path):
    """Places come from doubles, the shares of a page once, and a word past the headings is taken as it is."""
    lines = [["a"] * 9, ["b"] * 9, ["c"] * 9, ["d"] * 10, ["e"] * 9]
    rows = [(k, "\n".join(" ".join(x) for x in lines)) for k in (6, 7, 10)]
    spark.createDataFrame([*rows, (8, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = catalogue_pages._pages(spark, str(tmp_path))
    assert "decimal" not in found._jdf.queryExecution().executedPlan().toString().lower()
    got = {(r.doc_id, r.page): r for r in found.collect()}
    spans = got[0, 6].spans
    assert [s.text for s in spans[9:14]] == ["Total Cost", "Fair Value", "Realized Value", "Gross MOIC", "Current Ownership"]
    assert spans[7].text == "Confidential" and spans[21].text == "$1,234" and spans[35].text == "CURRENT FAIR VALUE" and spans[36].text == "d"
    assert (spans[10].x0, spans[10].x1, spans[10].y0, spans[10].size, spans[9].dir_x) == (31.5, 36.5, 12.0, 9.0, -1.0)
    assert got[1, 0].spans[1].x0 == 33.0 and got[0, 7].spans[9].text == "b" and got[0, 8].spans is None


def test_cells_move_once_by_row(spark):
    """A row's texts are joined where the row is: spans, repeats, nulls and gaps as before, no shuffle by column."""
    cells = spark.createDataFrame(
        [("t", 0, 0, 0, 2, "Un\nreal", 3), ("t", 1, 1, 1, None, "Gain", 3), ("t", 2, 1, 1, None, "x", 3), ("t", 3, 2, 2, None, None, 3),
         ("t", 5, 4, 0, 1, "late", 3), ("u", 0, 0, 0, None, "a", 1)],
        "table_id string, cell_ord int, row_index int, column_index int, column_span int, content string, column_count int")
    rows = grid.table_rows(cells)
    assert "col_idx#" not in "".join(p for p in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in p)
    assert {(r.table_id, r.row_idx): list(r["values"]) for r in rows.collect()} == {
        ("t", 1): ["Un real ", "Un real Gainx", ""], ("t", 2): ["", "", ""], ("t", 4): ["late", "", ""], ("u", 0): ["a"]}
    assert {(r.row_idx, r.col_idx, r.value) for r in grid.cell_texts(cells.where("table_id = 't'")).collect()} == {
        (1, 0, "Un real "), (1, 1, "Un real Gainx"), (2, 2, ""), (4, 0, "late")}
