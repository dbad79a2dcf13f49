import pytest


@pytest.fixture(scope="session")
def docs_frame(spark):
    def make(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id bigint, text string" + extra)

    return make
