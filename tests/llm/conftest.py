import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture
def texts(spark):
    """A frame of (doc_id, text) rows with columns of clashing names beside."""

    def make(rows, parts=3):
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        return frame.selectExpr("*", "1 as count", "'x' as n", "doc_id as digest", "array(1) as at")

    return make

