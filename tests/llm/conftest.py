import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, over several partitions."""

    def make(rows, partitions=3):
        return spark.createDataFrame([(*r, "s")[:3] for r in rows], DOCS).repartition(partitions)

    return make
