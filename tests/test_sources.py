"""Files in and out, and incremental runs."""

import json

import pytest

from tablefolio.sources import records, sinks
from tablefolio.sources.csv_tables import read_tables
from tablefolio.streaming.incremental import process_new_cells


def test_manifest_users_activity(spark, tmp_path):
    report = tmp_path / "rep"
    report.mkdir()
    (report / "structuredData.json").write_text(json.dumps({"extended_metadata": {"page_count": 4}, "elements": [
        {"Page": 0}, {"filePaths": ["a"], "Page": 1, "attributes": {"NumCol": 2}}, {"filePaths": ["b"]},
        {"filePaths": ["c"], "Page": 3, "attributes": {"NumCol": 5, "NumRow": 6}}]}, indent=1))
    got = [tuple(r) for r in records.read_manifests(spark, str(report)).collect()]
    assert got == [("rep", 4, "rep/rep_0.csv", 2, None, 1), ("rep", 4, "rep/rep_2.csv", 5, 6, 3)]
    users = tmp_path / "users.json"
    users.write_text(json.dumps({"users": [{"id": 1, "firstName": "A", "lastName": "B"}, {"id": 2, "firstName": "C"}]},
                                indent=1))
    assert {r.id: r.userName for r in records.read_users(spark, str(users)).collect()} == {1: "A B", 2: None}
    log = tmp_path / "log.csv"
    log.write_text("userId,createdAt,updatedAt,pageName,actionType\n1.0,2024-01-02 03:04:05,bad,p,Q\nx,2024-01-02,,p,Q\n")
    row = records.read_activity(spark, str(log)).collect()
    assert len(row) == 1 and row[0].userId == 1 and row[0].createdAt.hour == 3 and row[0].updatedAt is None


def test_master_source(spark):
    spark.createDataFrame([(1, "Acme")], "CompanyID int, CompanyName string").createOrReplaceTempView("known_companies")
    assert records.master_companies(spark, "known_companies").first() == (1, "Acme")
    with pytest.raises(ValueError):
        records.master_companies(spark, "unknown_companies")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("f1", "t1", 0, ["a", "b"]), ("f2", "t2", 0, ["c", None])],
                                 "fund_name string, table_id string, row_idx int, values array<string>")
    sinks.write_tables(rows, str(tmp_path / "t"))
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"fund_name=f1", "fund_name=f2"}
    heads = spark.createDataFrame([("f1", "t1", ["x", 'say "hi"']), ("f2", "t2", ["x", "y,z"])], "fund_name string, table_id string, header array<string>")
    more = spark.createDataFrame([("f1", "t1", i, [f"a{i}", "two\nlines" if i == 4 else None]) for i in range(40)], rows.schema)
    sinks.write_table_files(heads, rows.where("fund_name = 'f2'").union(more), str(tmp_path / "c"))
    got_heads, got_rows = read_tables(spark, str(tmp_path / "c" / "*" / "*"), has_index_col=False)
    assert sorted(r.header for r in got_heads.collect()) == [["x", 'say "hi"'], ["x", "y,z"]]
    back = sorted((r.row_idx, r["values"]) for r in got_rows.where("table_id LIKE '%t1%'").collect())
    assert back == [(i, [f"a{i}", "two\nlines" if i == 4 else None]) for i in range(40)]
    sinks.write_csv(rows.drop("values"), str(tmp_path / "x"))
    sinks.write_sheet(rows, str(tmp_path / "s"))
    done = sinks.read_done(spark, str(tmp_path / "s"), "table_id").where("table_id = 't1'")
    assert [r.table_id for r in sinks.not_yet_done(rows, done, "table_id").collect()] == ["t2"]
    registry = spark.createDataFrame([("p", "n", 1, 1, 1, "SIT", True)], "report_path string, report_name string, "
                                     "page_count int, page_ori int, page_new bigint, table_type string, is_processed boolean")
    assert sinks.append_registry(registry, registry.drop("page_ori")).count() == 2
    with pytest.raises(ValueError):
        sinks.append_registry(registry, registry.withColumnRenamed("page_ori", "other"))


def cells(table, firms):
    grid = [["Company", "Cost", "Fair Value", "Total"], *[[f, "$1", "2", "3"] for f in firms]]
    return [{"table_id": table, "cell_ord": 4 * r + c, "page": 1, "row_index": r, "column_index": c, "content": v,
             "row_count": len(grid), "column_count": 4} for r, line in enumerate(grid) for c, v in enumerate(line)]


def test_incremental(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def add(name, firms):
        (source / f"{name}.json").write_text("\n".join(map(json.dumps, cells(name, firms))))
        process_new_cells(spark, str(source), out, state)
        return {r.table_id: r.n for r in spark.read.parquet(f"{out}/facts").groupBy("table_id").count()
                .withColumnRenamed("count", "n").collect()}

    assert add("one", ["Aa", "Bb", "Cc", "Dd"]) == {"one": 4}
    assert add("two", ["Ee", "Ff", "Gg", "Hh", "Ii"]) == {"one": 4, "two": 5}
