import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text, source), with columns whose names clash with those used inside."""

    def make(rows, clash=True):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clash:
            for name in ("row", "k", "k1", "node", "text_signature", "id", "kept", "size", "_range", "fold", "block"):
                df = df.selectExpr("*", f"cast(null as string) as `{name}`")
        return df

    return make


#: Null, empty and blank texts, null ids and sources, repeated rows, ties, and one long text.
ODD = [
    (1, "alpha beta gamma", "a"), (1, "alpha beta gamma", "a"), (2, None, "a"), (3, "", None), (4, " \n\t", "b"), (None, "alpha beta", None),
    (None, None, None), (5, "x" * 3000, "b"), (6, " ".join(f"w{i % 97}" for i in range(4000)), "c"), (6, "other text of the same id", "c"),
]
