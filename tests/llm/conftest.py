import pytest


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) as a table with further columns whose names operators use inside."""

    def make(rows, extra=True):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return df.selectExpr("*", "'x' AS lang", "1 AS bucket", "'y' AS same", "2 AS n", "3 AS part", "'z' AS component_id") if extra else df

    return make
