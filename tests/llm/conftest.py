import pytest

from blockfee.llm.shared import send_package


@pytest.fixture(autouse=True)
def package(spark):
    send_package(spark)
