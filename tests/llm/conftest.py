import pytest

from tunewright.llm.common import prepare


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, id LONG, key STRING, _key LONG, `row` LONG"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, lang, source]), with extra columns whose names operators use inside."""

    def make(rows):
        full = [(*row, *(None,) * (4 - len(row)), 0, 1, "k", 2, 3) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make
