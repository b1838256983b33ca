import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import edge


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    return edge.frame(spark)


@pytest.fixture(scope="session")
def no_docs(spark):
    return edge.frame(spark).where("doc_id = -12345")


@pytest.fixture(scope="session")
def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
