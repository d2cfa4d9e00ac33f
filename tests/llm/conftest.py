import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Rows and a schema as a DataFrame of several partitions."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(3)
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
