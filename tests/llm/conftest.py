import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, extra=False):
        """Documents numbered from 0; a (id, text) pair sets its own id. extra: columns whose names clash."""
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, None if i is None or i % 3 else "en", f"s{i}" if i else None,
                                     len(t) if t else None) for i, t in rows], DOCS)
        if extra:
            for c in ("id", "node", "doc", "start", "label", "row", "spans", "score", "text_view", "n", "key", "x", "item"):
                df = df.selectExpr("*", f"'{c}' as {c}")
        return df.repartition(3)

    return make
