"""Registered corpus queries: with SQL as DuckDB, the others whole; the pipeline stage by stage."""

import os

import pytest

import corpus_pipeline
from tablefolio.llm.queries import QUERIES
from tablefolio.plans.catalogue import table
from tests.check_sql import compare, duck
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_line_dedup import brute as without_lines
from tests.llm.test_minhash import brute as classes

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_as_sql(spark, name):
    rows, difference = compare(spark, duck(SF), SF, QUERIES[name])
    assert difference is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_a_row_per_document(spark, name):
    out = QUERIES[name].run(spark, SF)
    ids = sorted(r.doc_id for r in out.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect())


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, texts = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            texts = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "quality classifier":
            labels = {r.doc_id: (r.quality, r.toxic) for r in table(spark, SF, "labels").collect()}
            good = [i for i, x in labels.items() if x == (1, 0)]
            assert sum(i in texts for i in good) >= 0.95 * len(good) and all(texts[i] == before[i] for i in texts)
        elif name == "line dedup":
            want = without_lines(before.items())
            assert texts == {i: t for i, t in want.items() if t or not before[i].strip()}
        elif name == "MinHash near-dedup":
            assert set(texts) == {i for i, x in classes(before.items(), corpus_pipeline.NEAR_PERCENT).items() if x[2]}
        elif name == "benchmark decontamination":
            found = leaks(before.items(), [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()])
            assert set(texts) == set(before) - {x[0] for x in found}
    assert {r.doc_id for r in docs.collect()} == set(texts)
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == {tuple(r) for r in docs.collect()}
