import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers_import(spark):
    from panelfold.llm.common import importable

    importable(spark)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text), in two partitions, with columns whose names operators use inside."""

    def make(rows, extra=True):
        schema = "doc_id long, text string" + (", h long, row_key string, first int, score_ double" if extra else "")
        return spark.createDataFrame([(i, t, *([1, "k", 2, 0.5] if extra else [])) for i, t in rows], schema).repartition(2)

    return make
