import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import ODD, docs_of  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return docs_of(spark, [])
