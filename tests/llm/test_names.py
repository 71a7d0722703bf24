"""Extra columns whose names clash with those the operators use inside change nothing."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablefolio.llm import line_dedup, quality
from tablefolio.llm.common import unused

CLASHES = ("__id", "__h", "__new", "__lang", "__gone", "__with", "__ID", "oid", "fp", "comp", "component_id", "kept", "row", "part")
LINE = "one line of more than ten words that several documents hold word by word"


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns and c != "__ID"])


@pytest.fixture
def docs(odd):
    return clashing(odd([f"{LINE}\nown text {k} of this document" for k in range(6)] + [None, ""]))


def test_names_not_in_use(docs):
    assert unused(docs, "__id", "__ID", "free") == ["__id_", "__ID_", "free"]


def test_line_dedup(docs):
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {0: f"{LINE}\nown text 0 of this document", **{k: f"own text {k} of this document" for k in range(1, 6)}, 6: None, 7: ""}


def test_deleted_lines_as_input_is_replaced(docs):
    out = line_dedup.dedup_lines(docs.withColumn("deleted_lines", F.lit("mine")))
    assert out.columns.count("deleted_lines") == 1 and {str(r.deleted_lines) for r in out.collect()} <= {"None", "[0]"}


def test_quality(spark, docs):
    labels = spark.createDataFrame([(k, 1, 0) for k in range(6)], "doc_id long, quality int, toxic int")
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and {6, 7} <= {r.doc_id for r in kept.collect()}


def test_stages_keep_all_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns and out.count() >= 1, name
