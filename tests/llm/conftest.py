from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents_of(spark):
    """Builds a documents table from texts or (doc_id, text[, lang, source]) rows."""

    def build(rows, parts=3):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if r is None or isinstance(r, str) else tuple(r)
            doc_id, text, lang, source = (*r, "en", "src0")[:4] if len(r) < 4 else r
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENT).repartition(parts) if full else spark.createDataFrame([], DOCUMENT)

    return build


@pytest.fixture(scope="session")
def clashing(documents_of):
    """Documents with extra columns named like results and helpers."""
    from pyspark.sql import functions as F

    names = ("kept", "n_words", "node", "id", "root", "value", "spans", "ids", "range", "part", "guest", "rest", "epoch", "component_id", "made", "digest", "license", "score", "fingerprint")

    def build(rows):
        return documents_of(rows).withColumns({n: F.lit("x") for n in names})

    return build


WORD = r"[^\x20\x09-\x0D]+"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
