import pytest

from tests.llm import corpus


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus.documents()[0], corpus.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def items(spark):
    return spark.createDataFrame(corpus.documents()[1], "item_id bigint, text string").cache()


@pytest.fixture(scope="session")
def edges(spark):
    return corpus.with_extras(spark.createDataFrame(corpus.edge_rows(), corpus.SCHEMA).repartition(3)).cache()


@pytest.fixture(scope="session")
def empty(edges):
    return edges.limit(0)
