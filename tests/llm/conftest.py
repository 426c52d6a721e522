import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import SCHEMA, cases  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(cases(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
