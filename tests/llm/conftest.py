import pytest

from tests.llm.cases import SCHEMA


@pytest.fixture
def docs(spark):
    """A table of documents from (doc_id, text, source), with columns whose names the operators use themselves."""

    def make(rows, parts=3):
        data = [(i, t, "en", s, 0, None, "x", 1, 2, "w", 3, "a", "b", 4) for i, t, s in (r if len(r) == 3 else (*r, "s1") for r in rows)]
        return spark.createDataFrame(data, SCHEMA).repartition(parts)

    return make
