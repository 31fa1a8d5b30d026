import pytest
from pyspark.sql import types as T

from strataledger.llm.common import tuned

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Extra columns whose names the operators use for results of their own.
        T.StructField("score", T.StringType()),
        T.StructField("sequence_id", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from texts, or from (doc_id, text) and (doc_id, text, lang)."""
    tuned(spark)

    def build(rows):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, *lang = row if isinstance(row, tuple) else (number, row)
            size = None if text is None else len(text)
            full.append((doc_id, text, lang[0] if lang else None, None, size, "x", "y", None))
        return spark.createDataFrame(full, DOCUMENT).repartition(3)

    return build
