"""Fixtures for the operators of the llm subpackage."""

import pytest


@pytest.fixture()
def docs(spark):
    """A documents table from (doc_id, text) pairs; the other columns clash with names in use."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, key string, n long, slot long"
        return spark.createDataFrame([(i, t, None, "src0", len(t or ""), "k", 1, 2) for i, t in rows], schema)

    return make
