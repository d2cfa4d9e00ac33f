import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from metaloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def one(spark):
    """Evaluates a column over one row of values."""
    def evaluate(build, *values, kinds=None):
        names = [f"c{i}" for i in range(len(values))]
        kinds = kinds or ["string"] * len(values)
        schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
        return spark.createDataFrame([tuple(values)], schema).select(build(*names)).head()[0]
    return evaluate
