import zlib

import pytest
from oracle import MEDIUM, SMALL  # noqa: F401 - either conftest may be the one imported by name
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text[, source]) as a documents table with a clashing extra column."""

    def make(rows, extra=True):
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(data, DOCS)
        return df.withColumnsRenamed({"n_chars": "row"}) if extra else df

    return make


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


EMPTY = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
