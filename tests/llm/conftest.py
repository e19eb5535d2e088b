"""Fixtures for the text operators."""

import pytest


@pytest.fixture()
def documents(spark):
    """Make a documents table from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "src0") for i, t in rows],
                                     "doc_id long, text string, lang string, source string")
    return make
