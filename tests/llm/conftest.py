"""Small frames and plain reference versions for the operator tests."""

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)
    return make
