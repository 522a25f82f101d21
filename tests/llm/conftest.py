import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from llm_fixtures import edge_docs, no_docs  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return edge_docs(spark)


@pytest.fixture(scope="session")
def empty(spark):
    return no_docs(spark)


@pytest.fixture(scope="session")
def sf_docs(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return spark.read.parquet(f"{SF}/documents.parquet")
