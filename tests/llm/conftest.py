import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_rows(spark):
    """(doc_id, text) of the smallest tables."""
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text").collect()]
