import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Make a documents table from (doc_id, text[, lang[, source]])."""

    def make(rows, partitions=3):
        full = []
        for doc_id, text, *more in rows:
            lang, source = [*more, "en", "a"][:2] if len(more) < 2 else more
            full.append((doc_id, text, lang, source, len(text) if text is not None else None))
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


def awkward(width=300_000):
    """Rows every operator must take: nulls, empty, blank, very long, no white space, repeated, non-ASCII."""
    long = " ".join(f"word{i % 977}" for i in range(width // 8))
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", "a"),
        (4, long, "en", "a"),
        (5, "x" * width, "en", "b"),
        (6, "the same text in two rows of one document", "en", "b"),
        (6, "the same text in two rows of one document", "en", "b"),
        (None, "a row without a key but with words", "en", None),
        (8, "Zażółć gęślą jaźń 日本語 🎉🎉 Straße ǅ", None, "b"),
        (9, "the same text in two rows of one document", "en", "c"),
    ]
