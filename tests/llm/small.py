from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame(list(rows), "doc_id LONG, text STRING")

    return make
