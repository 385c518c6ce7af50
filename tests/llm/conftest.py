"""Small helpers for the text operators' tests."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    def make(texts, schema=DOC_SCHEMA):
        return spark.createDataFrame(
            [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in enumerate(texts)], schema
        )

    return make
