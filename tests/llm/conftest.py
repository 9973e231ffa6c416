import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from starloom.llm.stage import ship

    ship(spark)
