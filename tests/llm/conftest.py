import pytest
from samples import CLASHES, SCHEMA, odd_rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("mine") for c in CLASHES})
