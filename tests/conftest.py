import pytest

from gradeloom.runtime import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", 4, spark__checkpoint__dir=shared)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Results of an expression over a column of texts, as a list in input order."""

    def run(texts, expression, schema="id int, t string"):
        rows = [(i, *(text if isinstance(text, tuple) else (text,))) for i, text in enumerate(texts)]
        df = spark.createDataFrame(rows, schema)
        return [row[1] for row in sorted(df.select("id", expression.alias("x")).collect(), key=lambda r: r[0])]

    return run
