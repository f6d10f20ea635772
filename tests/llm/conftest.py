from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark: SparkSession):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows) -> DataFrame:
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)
    return make
