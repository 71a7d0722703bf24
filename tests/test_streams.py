"""Session streams, versioned tables and the sheet function against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablefolio.functions.sheets import register_sheet_cells
from tablefolio.operators.headers import mostly_unnamed
from tablefolio.sources.versioned import VersionedTable
from tablefolio.streaming.sessions import close_sessions, session_totals, split_late

ZERO = datetime(2024, 3, 1)
SCHEMA = "user int, ts timestamp, n long"


def plain_sessions(rows, gap):
    out, last = [], {}
    for user, ts, n in sorted(rows):
        if user in last and ts - last[user][2] <= gap:
            s = last[user]
            s[2], s[3], s[4] = ts, s[3] + 1, s[4] + n
        else:
            last[user] = [user, ts, ts, 1, n]
            out.append(last[user])
    return sorted((u, a, b + gap, k, n) for u, a, b, k, n in out)


def test_sessions_over_restarts(spark, tmp_path):
    """Each run goes on where the last one stopped; rows that come too late are set apart and change no session."""
    rng = random.Random(1)
    arrivals, kept, late, top = [], [], [], None
    for k in range(3):
        rows = [(rng.randint(1, 4), ZERO + timedelta(minutes=rng.randint(-80 if k else 0, 300) + 300 * k), rng.randint(0, 9))
                for _ in range(60)]
        rows = [(u, ts + timedelta(microseconds=i), n) for i, (u, ts, n) in enumerate(rows)]
        arrivals.append(rows)
        for r in rows:
            (late if top and r[1] < top - timedelta(minutes=20) else kept).append(r)
        top = max([*([top] if top else []), *(r[1] for r in rows)])
    schema = spark.createDataFrame([], SCHEMA).schema
    here = str(tmp_path)
    for k, rows in enumerate(arrivals):
        spark.createDataFrame(rows, SCHEMA).coalesce(2).write.mode("append").parquet(f"{here}/in")
        for _ in range(2):  # a run without new files changes nothing
            split_late(spark, f"{here}/in", schema, f"{here}/split", f"{here}/s1", "ts", "20 MINUTES")
        if k == 2:
            close_sessions(spark, f"{here}/split/on_time", schema, "ts", timedelta(days=2))
        session_totals(spark, f"{here}/split/on_time", schema, f"{here}/out", f"{here}/s2", "user", "ts", "n", "15 minutes", "20 minutes")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{here}/out").where("user IS NOT NULL").collect())
    assert late and got == plain_sessions(kept, timedelta(minutes=15))
    assert sorted(map(tuple, spark.read.schema(schema).parquet(f"{here}/split/late/*").collect())) == sorted(late)


def test_versions(spark, tmp_path, monkeypatch):
    """A batch that is lost before its list is written leaves no trace; one that comes again is applied once."""
    def frame(rows):
        return spark.createDataFrame(rows, "k int, name string, n double")

    def rows(version=None):
        return sorted((r.k, r.name, r.n) for r in versions.read(version).collect())

    versions = VersionedTable(spark, str(tmp_path / "t"), ("k",), buckets=4)
    assert versions.version() == -1
    start = [(i, f"a{i}", float(i)) for i in range(12)]
    versions.create(frame(start))
    assert versions.version() == 0 and rows() == start
    batch = [(3, "b", None), (3, "c", 1.0), (3, "c", 1.0), (20, None, 2.0)]

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_commit", lost)
        with pytest.raises(OSError, match="lost"):
            versions.upsert(frame(batch), "one", F.coalesce("n", F.lit(9.0)))
    assert versions.version() == 0 and rows() == start
    for _ in range(2):
        assert versions.upsert(frame(batch), "one", F.coalesce("n", F.lit(9.0))) == 1
    want = sorted([r for r in start if r[0] != 3] + [(3, "b", None), (20, None, 2.0)])
    assert rows() == want and rows(0) == start
    assert versions.upsert(frame([(5, "a5", 5.0)]), "same") == 2 and rows() == want
    assert versions.upsert(frame([]), "empty") == 3 and rows() == want
    assert {(r.k, r.change) for r in versions.changes(0).collect()} == {(3, "updated"), (20, "inserted")}
    assert versions.changes(1, 2).collect() == [] and {r.change for r in versions.changes(1, 0).collect()} == {"updated", "deleted"}


def test_versions_of_an_empty_table(spark, tmp_path):
    versions = VersionedTable(spark, str(tmp_path / "t"), ("a", "b"), buckets=3)
    versions.create(spark.createDataFrame([], "a int, b string, c int"))
    assert versions.read().collect() == []
    versions.upsert(spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "a int, b string, c int"), "first")
    assert {tuple(r) for r in versions.read().collect()} == {(1, "x", 1), (1, "y", 2)}


def test_versions_from_a_stream(spark, tmp_path):
    """As the sink of a bounded stream: every batch is one version, whatever run brings it."""
    versions = VersionedTable(spark, str(tmp_path / "t"), ("k",), buckets=2)
    versions.create(spark.createDataFrame([(1, "old")], "k int, v string"))
    for k in range(2):
        spark.createDataFrame([(1, f"new{k}"), (10 + k, "x")], "k int, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(lambda df, n: versions.upsert(df, f"stream-{n}") and None).option(
            "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert {tuple(r) for r in versions.read().collect()} == {(1, "new1"), (10, "x"), (11, "x")} and versions.version() == 2


def test_sheet_function(spark):
    """Headers are promoted exactly where the column expression says so."""
    register_sheet_cells(spark)
    headers = {"a": ["x", "y", "z"], "b": ["", None, "z"], "c": ["Unnamed: 0", "y", "z"], "d": [""], "e": [], "f": ["x", ""]}
    rows = [(s, -1, h) for s, h in headers.items()]
    rows += [(s, i, [f"{s}{i}", None, "w", "more"][: 4 if i == 1 else 3]) for s in headers for i in range(3)]
    df = spark.createDataFrame(rows, "sheet string, place int, `values` array<string>")
    df.createOrReplaceTempView("some_sheets")
    got = {}
    for r in spark.sql("SELECT * FROM sheet_cells(TABLE(SELECT * FROM some_sheets) PARTITION BY sheet ORDER BY place)").collect():
        got.setdefault(r.sheet, {}).setdefault(r.row_idx, []).append((r.name, r.value))
    promoted = {r.sheet for r in df.where("place = -1").where(mostly_unnamed(F.col("values"))).collect()}
    assert promoted == {"b", "d"}
    for sheet, header in headers.items():
        body = [v for s, i, v in rows if s == sheet and i >= 0]
        if sheet in promoted:
            header, body = body[0], body[1:]
        want = {k: [(header[i] if i < len(header) and header[i] and "Unnamed" not in header[i] else str(i), v)
                    for i, v in enumerate(values)] for k, values in enumerate(body)}
        assert got.get(sheet, {}) == want
