from __future__ import annotations

import pytest

import __spark_entry__


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    __spark_entry__.importable(spark)
