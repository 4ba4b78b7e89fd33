import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from rows and a schema, over a few partitions."""

    def build(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return build
