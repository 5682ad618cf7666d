import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from ticklake.llm.common import ship_package

    ship_package(spark)


@pytest.fixture
def docs(spark):
    """Documents from (id, text) or (id, text, source); with columns whose
    names operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", 1, 2.0, b"x", 3, 4) for r in rows]
        schema = "doc_id long, text string, source string, size int, score double, node binary, n int, hash int"
        return spark.createDataFrame(full, schema)

    return make
