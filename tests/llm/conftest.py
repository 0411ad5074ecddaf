import pytest

from llm_cases import SCHEMA, edge_rows


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The edge rows as a stored table, in several files."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from citylake.llm import common

    return common.prepared(spark)
