import pytest
from pyspark.sql import types as T

from tests.llm.helpers import sample_texts

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use inside themselves
    T.StructField("digest", T.StringType()), T.StructField("key", T.LongType()),
    T.StructField("slot", T.LongType()), T.StructField("w", T.StringType()),
    T.StructField("found", T.StringType()), T.StructField("_key", T.StringType())])


@pytest.fixture(scope="session")
def rows():
    texts = sample_texts()
    made = [(k, t, "en", "src0", len(t) if t else 0) for k, t in enumerate(texts)]
    made.append(made[-1])                            # a repeated row
    made.append((None, "a text whose id is missing and nothing else", None, None, None))
    return made


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([r + ("d", 7, 7, "w", "f", "k") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
