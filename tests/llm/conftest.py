import pytest

from forgemart.llm.queries import ship


@pytest.fixture(autouse=True)
def _code_on_workers(spark):
    ship(spark)
