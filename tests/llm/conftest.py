import pytest


@pytest.fixture(scope="session")
def odd(spark):
    from llm.cases import ODD, documents

    return documents(spark, ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    from llm.cases import documents

    return documents(spark, [])
