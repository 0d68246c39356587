import os
import sys

import pytest
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from stallkeeper.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def one_value(spark):
    """Evaluates an expression for one input value given as a column ``v``."""

    def evaluate(expression, value, dtype="string"):
        df = spark.range(1, numPartitions=1).select(F.lit(value).cast(dtype).alias("v"))
        return df.select(expression.alias("r")).first()[0]

    return evaluate
