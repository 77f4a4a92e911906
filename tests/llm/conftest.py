import pytest
from llm_corpus import DOCUMENTS, corpus


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(corpus(), DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
