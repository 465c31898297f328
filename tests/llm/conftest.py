import pytest

from paytrail.llm import common


@pytest.fixture(scope="session")
def table(spark):
    """Rows as a stored table, as operators get them."""

    def make(rows, schema):
        return common.store(spark.createDataFrame(rows, schema), "test")

    return make


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
