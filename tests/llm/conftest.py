import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """A maker of documents tables with extra columns whose names clash with those the operators use inside."""

    def make(texts, ids=None, lang="en"):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
        df = spark.createDataFrame(rows, DOCS)
        for clash in ("id", "h", "k", "g", "a", "b", "n", "row", "doc", "seed", "sig", "words", "link", "spans", "item_id"):
            df = df.withColumn(clash, F.lit("x"))
        return df

    return make
