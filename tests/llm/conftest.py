import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts, or from (id, text) pairs."""

    def make(texts):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def folder_of(tmp_path_factory):
    """A folder with tables as Parquet, as the queries read it."""

    def make(**tables):
        path = str(tmp_path_factory.mktemp("data"))
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return path

    return make
