import pytest

from feedloom.llm.common import reachable


@pytest.fixture(autouse=True)
def workers(spark):
    return reachable(spark)
